from __future__ import annotations

import random

from pyspark.sql import functions as F

from postmill.operators import postings
from postmill.plans import reports


def messages(spark, n=700):
    draw = random.Random(2)
    words = ["every", *[f"w{i}" for i in range(60)]]
    rows = []
    for i in range(n):
        body = " ".join(["Every", *draw.choices(words, k=draw.randrange(12))]) if i % 50 else draw.choice(["", None])
        rows.append((f"u{i % 9}@{draw.choice(['a.org', 'b.org', 'c.org'])}", i, body, draw.choice([None, 0.5, -1.25, 3.0])))
    return spark.createDataFrame(rows, "`from` string, ts long, body string, sentiment float")


def test_totals_of_several_domains_from_one_index(spark, tmp_path):
    scored = messages(spark)
    postings.write_index(scored, str(tmp_path))
    for domain in ("a.org", "b.org", "none.org"):
        got = postings.word_totals(spark, str(tmp_path), scored.drop("body"), domain).collect()
        wanted = reports.words_by_sentiment(scored, domain).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, wanted), key=str)


def test_blocks_are_bounded_and_decode_to_what_they_were(spark, tmp_path):
    postings.write_index(messages(spark, 2000), str(tmp_path))
    stored = spark.read.parquet(str(tmp_path / "postings"))
    sizes = {r["block"]: len(r["tfs"]) for r in stored.where("word = 'every'").collect()}
    assert len(sizes) >= 7 and max(sizes.values()) <= postings.BLOCK and sum(sizes.values()) == 1960
    tokens = spark.read.parquet(str(tmp_path / "messages")).select("number", F.explode("words").alias("word"))
    wanted = tokens.groupBy("word", "number").agg(F.count("*").cast("int").alias("tf"))
    got = postings.entries(stored)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.select("word", "number", "tf").collect()))
    # Numbers of one domain follow each other.
    spans = spark.read.parquet(str(tmp_path / "messages")).groupBy("from_domain").agg(F.min("number"), F.max("number")).collect()
    ordered = sorted((low, high) for _, low, high in spans)
    assert all(a[1] < b[0] for a, b in zip(ordered[:-1], ordered[1:], strict=True))


def test_scores_of_the_index_and_scores_beyond_the_broadcast(spark, tmp_path, monkeypatch):
    scored = messages(spark)
    postings.write_index(scored, str(tmp_path), ("sentiment",))
    half = scored.where("ts % 2 = 0")
    for blocks in (postings.BROADCAST_BLOCKS, 0):
        monkeypatch.setattr(postings, "BROADCAST_BLOCKS", blocks)
        for given, rows in ((None, scored), (half.drop("body"), half)):
            got = postings.word_totals(spark, str(tmp_path), given, "a.org")
            assert ("strategy=broadcast" in got._jdf.queryExecution().analyzed().toString()) == (blocks > 0)
            wanted = reports.words_by_sentiment(rows, "a.org").collect()
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, wanted), key=str)


def test_kept_sums_stand_for_whole_blocks(spark, tmp_path, monkeypatch):
    """Blocks inside a domain are added up as they are stored; those at its ends are opened."""
    monkeypatch.setattr(postings, "BLOCK", 16)
    scored = messages(spark, 900).repartition(3)
    postings.write_index(scored, str(tmp_path), ("sentiment",))
    stored = spark.read.parquet(str(tmp_path / "postings"))
    assert stored.agg(F.sum("n")).first()[0] == postings.entries(stored).count()
    opened, block_scores = [], postings.block_scores
    monkeypatch.setattr(postings, "block_scores", lambda rows: opened.append(rows.count()) or block_scores(rows))
    for domain in ("a.org", "b.org", "c.org", "none.org"):
        got = postings.word_totals(spark, str(tmp_path), None, domain).collect()
        wanted = reports.words_by_sentiment(scored, domain).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, wanted), key=str)
    assert max(opened) < 2 * 16 and opened[-1] == 0
