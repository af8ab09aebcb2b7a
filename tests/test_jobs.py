from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postmill.operators import versions
from postmill.plans import jobs, keywords, reports
from postmill.sinks import tables
from registered import inputs
from tests.conftest import SMALL


def lines(folder):
    return sorted(line for part in folder.glob("part-*") for line in part.read_text().splitlines())


def test_jobs_over_a_stored_table(spark, tmp_path):
    emails = inputs.emails(spark, SMALL)
    path = str(tmp_path / "emails")
    tables.write_emails(emails, path)

    jobs.summary_job(spark, path, str(tmp_path / "out"))
    for name, report in (("top-senders", reports.top_senders), ("top-correspondents", reports.top_correspondents)):
        expected = ["\t".join(map(str, row)) for row in report(emails).collect()]
        [part] = (tmp_path / "out" / name).glob("part-*")
        assert part.read_text().splitlines() == expected

    jobs.keywords_job(spark, path, str(tmp_path / "out"), inputs.STOP_WORDS)
    best = keywords.message_keywords(emails, inputs.STOP_WORDS).select("doc", "word", F.col("score").cast("string"))
    assert lines(tmp_path / "out" / "tf-idf-matrix") == sorted("\t".join(row) for row in best.collect())


def test_a_second_scoring_adds_a_newer_version(spark, tmp_path):
    path, out = str(tmp_path / "emails"), str(tmp_path / "sentiment")
    tables.write_emails(inputs.emails(spark, SMALL), path)
    lexicon = inputs.lexicon(spark)
    jobs.sentiment_job(spark, path, lexicon, out, F.lit(1))
    jobs.sentiment_job(spark, path, lexicon.withColumn("score", (F.col("score") * 2).cast("float")), out, F.lit(2))
    cells = spark.read.parquet(out)
    latest = versions.latest_versions(cells, ["from", "message_ts"])
    first = cells.filter("ts = 1")
    assert cells.count() == 2 * first.count() == 2 * latest.count()
    doubled = first.join(latest, ["from", "message_ts"]).filter(first["value"] * 2 != latest["value"])
    assert doubled.count() == 0


def test_scratch_folder_is_a_shared_one():
    from types import SimpleNamespace

    from postmill.session import scratch_folder

    def session(master, **conf):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda name, *default: conf.get(name.split(".")[-2], *default)),
            sparkContext=SimpleNamespace(master=master),
        )

    assert scratch_folder(session("local[4]", warehouse="/w")).startswith("/w/postmill-")
    assert scratch_folder(session("yarn", checkpoint="hdfs:///c/")).startswith("hdfs:///c/postmill-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(session("yarn", warehouse="/w"))
