"""URL filters: pattern rules found by their rarest literal token.

Each rule is filed under the one of its literal tokens that the fewest rules share.
The tokens of a URL fetch the candidate rules by an equality join, and only those run
their regular expression.  Every different URL is judged once.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.common import ASCII_LOWER, ASCII_UPPER, written

TOKEN = "[A-Za-z0-9]+"
#: Filed under this token, a rule is a candidate for every URL.
ANY = ""
#: Rules of more characters than this meet the tokens in a shuffle.
BROADCAST_CHARS = 16 << 20


@dataclass(frozen=True)
class Rule:
    """A verdict for the addresses (host and path) that ``pattern`` finds.

    ``tokens`` are whole tokens of every such address; ``weight`` ranks the rules that
    find one address (the greatest wins, then the least name).
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    weight: int


def host_rule(verdict: str, address: str) -> Rule:
    """A rule such as ``example.org/es/``: a host with its subdomains, and how the path begins."""
    host, slash, rest = address.partition("/")
    path = slash + rest
    # The last token of the path may go on in the address, unless a separator ends it.
    closed = re.sub(r"[A-Za-z0-9]+$", "", path)
    tokens = tuple(re.findall(TOKEN, host) + re.findall(TOKEN, closed))
    escaped = re.sub(r"([^A-Za-z0-9/])", r"\\\1", host + path)
    return Rule(address, verdict, rf"^(?:[^/]*\.)?{escaped}", tokens, len(address))


def pattern_rule(name: str, verdict: str, pattern: str, tokens: Sequence[str], weight: int = 0) -> Rule:
    return Rule(name, verdict, pattern, tuple(tokens), weight)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, ASCII_UPPER, ASCII_LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_index(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules, each under its rarest token (the longest, then the least of equals)."""
    shared = Counter(token for rule in rules for token in set(rule.tokens))
    rows = []
    for rule in rules:
        token = min(rule.tokens, key=lambda t: (shared[t], -len(t), t), default=ANY)
        rows.append(
            {"token": token, "rule": rule.name, "rule_verdict": rule.verdict, "pattern": rule.pattern, "weight": rule.weight}
        )
    text = json.dumps(rows)
    schema = "array<struct<token: string, rule: string, rule_verdict: string, pattern: string, weight: int>>"
    index = spark.range(1).select(F.inline(F.from_json(F.lit(text), schema)))
    return F.broadcast(index) if len(text) <= BROADCAST_CHARS else index


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` and ``host``, ``path``, ``rule`` and ``verdict`` of the URL.

    ``rule`` is null and ``verdict`` the default where no rule fits.  Host and path of
    a null URL, or one without ``://``, are empty.  New columns replace those of their
    names.  Equal URLs get equal verdicts; with no rules all get the default.

    The decisions on the different URLs are stored before they are joined back: the
    join then has two plain shuffles, of which Spark can split a common URL's.
    """
    index = rule_index(pages.sparkSession, rules)
    urls = pages.select(F.col(f"`{url}`").alias("__url")).where("__url is not null").distinct()
    address = urls.withColumn("address", F.concat(host_of(F.col("__url")), path_of(F.col("__url"))))
    tokens = F.array_distinct(F.concat(F.array(F.lit(ANY)), F.regexp_extract_all("address", F.lit(TOKEN), F.lit(0))))
    found = (
        address.select("__url", "address", F.explode(tokens).alias("token"))
        .join(index, "token")
        .where(F.expr("address rlike pattern"))
        .groupBy("__url")
        .agg(
            F.min(F.struct(-F.col("weight"), F.col("rule"), F.col("rule_verdict"))).alias("best")
        )
        .select("__url", F.col("best.rule").alias("__rule"), F.col("best.rule_verdict").alias("__verdict"))
    )
    new = {"host", "path", "rule", "verdict"}
    kept = [f"`{c}`" for c in pages.columns if c.lower() not in new]
    found = written(found)
    source = pages.withColumn("__url", F.col(f"`{url}`"))
    return source.join(found, "__url", "left").select(
        *kept,
        F.coalesce(host_of(F.col("__url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("__url")), F.lit("")).alias("path"),
        F.col("__rule").alias("rule"),
        F.coalesce("__verdict", F.lit(default)).alias("verdict"),
    )
