from __future__ import annotations

import pytest

from postmill.llm import queries, urls
from tests.conftest import SMALL
from tests.llm import brute

ODD = [
    None, "", "no scheme", "http://", "://Example.ORG/es/1", "https://a.example.org/en/148.html?x=1", "x://org/",
    "https://notexample.org/es/", "http://org", "http://.org/", "http://WWW.Example.Com/fr/9#top", "http://com/de",
    "http://x.com/de/", "http://example.org/EN/1", "http://example.org/en/1", "http://É.org/é", "a://b://example.org/es/",
    "http://example.org?/es/", "http://example.org#x/es/", "http://exampleXorg/es/", "http://y.org:80/es/", "http://a b.org/ c",
    "http://example.org/en/1", "http://" + "a." * 20000 + "org/" + "x/" * 20000,
]


def judged(spark, values):
    frame = spark.createDataFrame(list(enumerate(values)), "page_id long, url string")
    rows = urls.judge(frame, queries.URL_RULES).collect()
    return {r["page_id"]: r for r in rows}


def test_odd_urls(spark):
    rows = judged(spark, ODD)
    for i, value in enumerate(ODD):
        host, path, rule = brute.url(value)
        row = rows[i]
        assert (row["host"], row["path"]) == (host, path), value
        assert row["rule"] == (rule.split(" ")[1] if rule else None), value
        assert row["verdict"] == (rule.split(" ")[0] if rule else "allow"), value


def test_whole_table(spark):
    frame = spark.read.parquet(f"{SMALL}/pages.parquet")
    source = {r["page_id"]: r["url"] for r in frame.select("page_id", "url").collect()}
    rows = queries.op1_url_filter(spark, SMALL).collect()
    assert len(rows) == len(source)
    for row in rows:
        host, path, rule = brute.url(source[row["page_id"]])
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule.split(" ")[1] if rule else None)


def test_repeated_rows_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "http://org/", "mine")] * 3, "page_id long, url string, host string")
    rows = urls.judge(frame, queries.URL_RULES).collect()
    assert [r["host"] for r in rows] == ["org"] * 3


def test_no_rules_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "http://org/")], "page_id long, url string")
    assert [r["verdict"] for r in urls.judge(frame, [], default="block").collect()] == ["block"]
    assert urls.judge(frame.limit(0), queries.URL_RULES).collect() == []


def test_rules_without_a_token_and_rarest_token(spark):
    rules = [
        urls.pattern_rule("short", "block", "/x[0-9]$", ()),
        urls.host_rule("allow", "example.org/only/"),
        urls.host_rule("allow", "example.org/"),
    ]
    index = {r["rule"]: r["token"] for r in urls.rule_index(spark, rules).collect()}
    assert index == {"short": urls.ANY, "example.org/only/": "only", "example.org/": "example"}
    frame = spark.createDataFrame([(1, "http://y/x1"), (2, "http://y/xx")], "page_id long, url string")
    rows = {r["page_id"]: r["verdict"] for r in urls.judge(frame, rules).collect()}
    assert rows == {1: "block", 2: "allow"}


@pytest.mark.parametrize("chars", [0, 1 << 20])
def test_the_way_without_broadcast_agrees(spark, monkeypatch, chars):
    monkeypatch.setattr(urls, "BROADCAST_CHARS", chars)
    assert judged(spark, ["http://example.org/es/"])[0]["verdict"] == "block"
