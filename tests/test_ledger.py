from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from postmill.operators import messages
from postmill.plans import mail_import
from postmill.sources import ledger, maildir

MESSAGE = """Message-ID: <{n}.x>
Date: Mon, 14 May 2001 16:39:{n:02d} -0700 (PDT)
From: {who}@corp.example.com
To: b@corp.example.com

body {n}
"""
NAMES = ["top", "a/1.", "a/2.", "a/_sent mail/1.", "a/_sent mail/.deep/1%.", "b[d]*/x?{y}.", "b[d]*/é 1", "c/_m3", "c/.m4"]


@pytest.fixture
def root(tmp_path):
    folder = tmp_path / "mail"
    for n, name in enumerate(NAMES):
        put(folder / name, MESSAGE.format(n=n, who="a"))
    put(folder / "a/.DS_Store", "junk")
    put(folder / "a/bad", "no headers")
    return folder


def put(path, text, at=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    if at:
        os.utime(path, (at, at))


def stored(spark, folder):
    return spark.read.parquet(f"{folder}/parsed")


def names_of(frame):
    return sorted(r["path"].rsplit("/", 1)[1] for r in frame.select("path").collect())


def test_walk_is_lazy_and_complete(spark, root):
    found = maildir.walk(spark, str(root))
    first = next(found)
    assert first[1] > 0 and first[2] > 0
    every = [first, *found]
    assert sorted(p.split("/mail/", 1)[1] for p, _, _ in every) == sorted([*NAMES, "a/bad"])


@pytest.mark.parametrize("block", [1, 3, 100])
def test_second_run_opens_nothing(spark, root, tmp_path, block):
    out = str(tmp_path / "out")
    assert ledger.import_new(spark, str(root), out, block=block) == (0, len(NAMES) + 1)
    tally = ledger.tally(stored(spark, out)).first()
    whole = messages.import_tally(messages.parse_messages(maildir.read_maildir(spark, str(root)))).first()
    assert tally == whole and tuple(tally) == (len(NAMES) + 1, len(NAMES) - 2, 3)
    before = stored(spark, out).inputFiles()
    assert ledger.import_new(spark, str(root), out, block=block) == (1, 0)
    assert sorted(stored(spark, out).inputFiles()) == sorted(before)


def test_new_changed_and_rejected_files(spark, root, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    ledger.import_new(spark, str(root), out)
    put(root / "a/new", MESSAGE.format(n=20, who="n"))
    put(root / "a/1.", MESSAGE.format(n=1, who="changed"))  # another length
    put(root / "top", MESSAGE.format(n=0, who="a"), at=1_000_000_000)  # another time
    opened = []
    read = maildir.read_files
    monkeypatch.setattr(maildir, "read_files", lambda s, paths: opened.extend(paths) or read(s, paths))
    assert ledger.import_new(spark, str(root), out) == (1, 3)
    assert sorted(p.rsplit("/", 1)[1] for p in opened) == ["1.", "new", "top"]
    parsed = stored(spark, out)
    assert tuple(ledger.tally(parsed).first()) == (len(NAMES) + 2, len(NAMES) - 1, 3)
    assert ledger.current(parsed).count() == len(NAMES) + 2 and parsed.count() == len(NAMES) + 4
    # Rejects are opened again on demand, and are right once the file is.
    put(root / "a/bad", MESSAGE.format(n=30, who="b"))
    os.utime(root / "a/bad")
    assert ledger.import_new(spark, str(root), out, retry_rejects=True) == (2, 3)
    assert tuple(ledger.tally(stored(spark, out)).first()) == (len(NAMES) + 2, len(NAMES), 2)
    assert names_of(stored(spark, out).where("load = 2 and reason is not null")) == [".m4", "_m3"]


def test_loads_upserted_one_by_one_equal_a_full_import(spark, root, tmp_path):
    from postmill.sinks import bucketed

    out, table = str(tmp_path / "out"), str(tmp_path / "emails")
    ledger.import_new(spark, str(root), out)
    first = mail_import.merge_messages(ledger.accepted_of_load(stored(spark, out), 0))
    bucketed.write_buckets(first, table, ["from", "ts"], 16)
    for n in range(40, 43):
        put(root / f"d/{n}", MESSAGE.format(n=n, who="late"))
    load, opened = ledger.import_new(spark, str(root), out)
    assert opened == 3
    new = mail_import.merge_messages(ledger.accepted_of_load(stored(spark, out), load))
    assert 1 <= len(bucketed.upsert_buckets(new, table)) <= 3
    whole, _ = mail_import.import_maildir(spark, str(root))
    got = bucketed.read_buckets(spark, table).select(whole.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_an_interrupted_import_goes_on(spark, root, tmp_path, monkeypatch):
    out, read, calls = str(tmp_path / "out"), maildir.read_files, []

    def fails(s, paths):
        calls.append(paths)
        if len(calls) == 3:
            raise OSError("lost")
        return read(s, paths)

    monkeypatch.setattr(maildir, "read_files", fails)
    with pytest.raises(OSError, match="lost"):
        ledger.import_new(spark, str(root), out, block=2)
    assert stored(spark, out).count() == 4
    monkeypatch.setattr(maildir, "read_files", read)
    assert ledger.import_new(spark, str(root), out, block=2)[1] == len(NAMES) + 1 - 4
    assert stored(spark, out).select(F.countDistinct("path")).first()[0] == len(NAMES) + 1 == stored(spark, out).count()


def test_empty_folder(spark, tmp_path):
    (tmp_path / "mail").mkdir()
    assert ledger.import_new(spark, str(tmp_path / "mail"), str(tmp_path / "out")) == (0, 0)
    assert ledger.write_listing(spark, str(tmp_path / "mail"), str(tmp_path / "listing")).count() == 0
