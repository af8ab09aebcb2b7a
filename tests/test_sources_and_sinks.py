from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postmill import schemas
from postmill.operators import counting, messages
from postmill.plans import mail_import, reports
from postmill.sinks import tables as table_sinks
from postmill.sinks import tsv
from postmill.sources import maildir, tables
from tests.conftest import plan_of

MESSAGE = """Message-ID: <{n}.x>
Date: Mon, 14 May 2001 16:39:{n:02d} -0700 (PDT)
From: {who}@corp.example.com
To: b@corp.example.com

body {n}
"""


@pytest.fixture
def mail_root(tmp_path):
    root = tmp_path / "maildir"
    files = {
        "top": 1,
        "smith-a/inbox/1.": 2,
        "smith-a/inbox/2.": 3,
        "smith-a/_sent_mail/1.": 4,
        "smith-a/_sent_mail/deep/_er/1.": 5,
        "jones-b/notes": 6,
        "jones-b/.hidden/1.": 7,
        "jones-b/year=2001/1.": 9,
        "jones-b/a/b/c/d/e/1.": 8,
    }
    for name, n in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(MESSAGE.format(n=n, who=name.split("/")[0]))
    (root / "smith-a/inbox/.DS_Store").write_text("junk")
    (root / "smith-a/inbox/3.").write_text("no headers")
    return root, {**files, "smith-a/inbox/3.": None}


def test_every_folder_is_read_once(spark, mail_root):
    root, files = mail_root
    found = [r["path"] for r in maildir.read_maildir(spark, str(root)).select("path").collect()]
    prefix = f"file:{root}/"
    assert sorted(f.removeprefix(prefix) for f in found) == sorted(files)


def test_no_file_is_lost(spark, mail_root):
    root, files = mail_root
    deep = root / "/".join(f"d{i}" for i in range(70))
    for folder, names in ((root / "a", ["_m3", ".m4", ".DS_Store"]), (root / "a/_b/.c/[d]*", ["_m5", "1."]), (deep, ["1."])):
        folder.mkdir(parents=True)
        for n, name in enumerate(names):
            (folder / name).write_text(MESSAGE.format(n=10 + n, who="a"))
    tally = mail_import.import_to_tables(maildir.read_maildir(spark, str(root)), str(root.parent / "out")).first()
    assert tally["files"] == len(files) + 5 == tally["parsed"] + tally["rejected"]
    rejects = spark.read.parquet(str(root.parent / "out/rejects")).where("reason = 'hidden_name'").collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in rejects) == [".m4", "_m3", "_m5"]


def test_maildir_import(spark, mail_root):
    root, files = mail_root
    raw = maildir.read_maildir(spark, str(root))
    tally = messages.import_tally(messages.parse_messages(raw)).first()
    assert (tally["files"], tally["parsed"], tally["rejected"]) == (len(files), len(files) - 1, 1)
    table, rejects = mail_import.import_maildir(spark, str(root))
    assert table.count() == len(files) - 1
    assert [r["reason"] for r in rejects.collect()] == ["no_date"]
    assert {r["body"] for r in table.collect()} >= {" body 4 ", " body 5 ", " body 8 "}


@pytest.mark.parametrize("target", ["emails", "employee"])
def test_import_into_a_folder(spark, mail_root, tmp_path, target):
    root, files = mail_root
    raw = maildir.read_maildir(spark, str(root))
    out = str(tmp_path / "out")
    tally = mail_import.import_to_tables(raw, out, target).first()
    assert tuple(tally) == (len(files), len(files) - 1, 1)
    stored = spark.read.parquet(f"{out}/{target}")
    table, rejects = mail_import.import_messages(raw, target)
    assert sorted(map(tuple, stored.select(*table.columns).fillna("").collect())) == sorted(
        map(tuple, table.fillna("").collect())
    )
    assert spark.read.parquet(f"{out}/rejects").collect() == rejects.collect()


def test_missing_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        maildir.read_maildir(spark, str(tmp_path / "none"))


def test_import_score_and_report_through_stored_tables(spark, mail_root, tmp_path):
    from postmill.operators import sentiment

    root, _ = mail_root
    table, _ = mail_import.import_maildir(spark, str(root))
    (tmp_path / "lexicon.txt").write_text("body\t2\ngood\t3\n")
    lexicon = tables.read_lexicon(spark, str(tmp_path / "lexicon.txt"))
    scored = sentiment.score_messages(table, lexicon, ["from", "ts"])
    table_sinks.write_emails(scored, str(tmp_path / "emails"))
    stored = spark.read.parquet(str(tmp_path / "emails"))
    [week] = reports.weekly_sentiment(stored, "corp.example.com").collect()
    assert (week["nummessages"], week["avgsentiment"]) == (9, 2.0)
    table_sinks.write_feature(
        sentiment.sentiment_cells(stored, ["from", "ts"], F.lit(5)), str(tmp_path / "sentiment")
    )
    assert spark.read.parquet(str(tmp_path / "sentiment")).count() == 9


def test_lexicon_source(spark, tmp_path):
    (tmp_path / "part-1").write_text("good\t3\nno fun\t-3\n")
    (tmp_path / "part-2").write_text('"quoted\t1\n')
    got = {r["word"]: r["score"] for r in tables.read_lexicon(spark, str(tmp_path)).collect()}
    assert got == {"good": 3.0, "no fun": -3.0, '"quoted': 1.0}


def test_stop_word_source(spark, tmp_path):
    (tmp_path / "stop").write_text("the\n and \n\n")
    assert [r["word"] for r in tables.read_stop_words(spark, str(tmp_path / "stop")).collect()] == ["the", "and"]


def test_keyed_ints(spark, tmp_path):
    (tmp_path / "lines").write_text("a:1\nb:2:3\nc\nd:x\ne:\nf:-7\ng:99999999999\nh: 1\n")
    good, bad = tables.read_keyed_ints(spark, str(tmp_path / "lines"))
    assert sorted(map(tuple, good.collect())) == [("a", 1), ("b", 2), ("f", -7)]
    assert good.schema["int"].dataType.simpleString() == "int"
    assert sorted(r["value"] for r in bad.collect()) == ["c", "d:x", "e:", "g:99999999999", "h: 1"]


def test_read_cells_reads_only_its_columns(spark, tmp_path):
    frame = spark.createDataFrame([("a", "x", "b1"), ("b", None, "b2")], "`from` string, to string, body string")
    frame.write.parquet(str(tmp_path / "t"))
    cells = tables.read_cells(spark, str(tmp_path / "t"), {"from": "sender", "to": "recipient"})
    assert [tuple(r) for r in cells.collect()] == [("a", "x")]
    assert "ReadSchema: struct<from:string,to:string>" in plan_of(cells)


def test_tsv(spark, tmp_path):
    frame = spark.createDataFrame([('a"b', 1, None), ("c d", 2, "x")], "s string, n int, t string")
    tsv.write_tsv(frame, str(tmp_path / tsv.TOP_SENDERS), single_file=True)
    [part] = (tmp_path / tsv.TOP_SENDERS).glob("part-*")
    assert sorted(part.read_text().splitlines()) == ['a"b\t1\t', "c d\t2\tx"]


def test_partitioned_and_bucketed_tables(spark, tmp_path):
    frame = spark.range(100).selectExpr("id % 3 as year", "id as ts", "string(id) as v")
    table_sinks.write_table(frame, str(tmp_path / "t"), partition_by=["year"], sort_by=["ts"])
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 100
    assert "PartitionFilters: [isnotnull(year" in plan_of(back.filter("year = 1"))
    table_sinks.save_bucketed(frame, "bucketed_cells", ["ts"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = spark.table("bucketed_cells"), spark.table("bucketed_cells")
        plan = plan_of(left.join(right, "ts"))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table bucketed_cells")


@pytest.mark.parametrize("form", ["parquet", "json"])
def test_records(spark, tmp_path, form):
    cells = spark.createDataFrame([("a",), ("a",), ("b",)], "value string")
    pairs = counting.value_pairs(cells)
    table_sinks.write_records(pairs, str(tmp_path / "pairs"), form)
    back = spark.read.schema(pairs.schema).format(form).load(str(tmp_path / "pairs"))
    assert sorted(r["key"]["id"] for r in back.collect()) == ["a", "a", "b"]


def test_tables_are_created_from_the_schemas(spark):
    names = schemas.create_tables(spark)
    try:
        assert sorted(names) == ["emails", "employee", "users"]
        assert spark.table("emails").columns == [f.name for f in schemas.EMAILS]
        assert spark.table("users").schema["example_record"].dataType.simpleString() == "struct<id:string>"
    finally:
        for name in names:
            spark.sql(f"drop table {name}")


def test_root_forms(spark, mail_root):
    root, files = mail_root
    for form in (f"{root}/", f"file:{root}", f"file://{root}"):
        assert maildir.read_maildir(spark, form).count() == len(files)
    with pytest.raises(ValueError):
        maildir.read_maildir(spark, "maildir")


def test_equality_filters_skip_row_groups_by_bloom_filter(spark, tmp_path):
    """Message ids stand in no order, so the least and the greatest of a row group tell nothing."""
    rows = spark.range(60_000).select(
        F.concat(F.lit("u"), (F.col("id") % 7).cast("string"), F.lit("@corp.example.com")).alias("from"),
        F.col("id").alias("ts"),
        F.sha2(F.col("id").cast("string"), 256).alias("mid"),
    )
    spark.conf.set("parquet.block.size", str(1 << 18))
    read = {}
    try:
        for name, bloom in (("with", {"mid": 10_000}), ("without", None)):
            path = str(tmp_path / name)
            table_sinks.write_table(rows.coalesce(1), path, sort_by=["from", "ts"], bloom=bloom)
            wanted = spark.range(1).select(F.sha2(F.lit("777"), 256)).first()[0]
            found = spark.read.parquet(path).where(F.col("mid") == wanted)
            assert [r["ts"] for r in found.collect()] == [777]
            plan = found._jdf.queryExecution().executedPlan()
            scans = plan.collectLeaves()
            read[name] = scans.apply(0).metrics().apply("numOutputRows").value()
    finally:
        spark.conf.unset("parquet.block.size")
    assert read["without"] == 60_000 and read["with"] < 30_000
