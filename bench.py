"""Wall time of the headline questions.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)

Prints one JSON line.  Each question runs to a sink that drops the rows, so all
rows are computed; the time includes building the plan.  The first run of each
warms the JVM and is reported apart.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from postmill.session import build_session  # noqa: E402
from registered.queries import QUERIES  # noqa: E402

HEADLINE = [
    "top_senders",
    "top_senders_by_versions",
    "top_correspondents",
    "top_correspondents_by_versions",
    "weekly_sentiment",
    "words_by_sentiment",
    "message_keywords",
    "message_sentiment",
    "imported_emails",
    "imported_employee",
    "copied_column",
    "value_counts",
    "keyed_ints",
    "document_frequency",
    "inverse_document_frequency",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "postmill-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    first = {name: run(name) for name in names}
    seconds = {name: min(run(name) for _ in range(RUNS)) for name in names}
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "wall time of the headline questions, best of three warm runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "first_run": {name: round(value, 3) for name, value in first.items()},
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
