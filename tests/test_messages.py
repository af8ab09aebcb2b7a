from __future__ import annotations

import random
import re

import pytest

from postmill.operators import messages
from postmill.plans import mail_import

DATE = "Date: Mon, 14 May 2001 16:39:00 -0700 (PDT)"
TS = 989883540000
BASE = ["Message-ID: <abc>", DATE, "From: a@corp.example.com"]


def text(*lines, base=BASE, body=None):
    head = "\n".join([*base, *lines]) + "\n"
    return head if body is None else head + "\n" + body


@pytest.fixture
def parse(spark):
    def run(*raws, profile=messages.REFERENCE):
        rows = [(f"{i:03d}", raw) for i, raw in enumerate(raws)]
        frame = spark.createDataFrame(rows, "path string, value string")
        return messages.parse_messages(frame, profile).orderBy("path").collect()

    return run


def test_whole_message(parse):
    raw = text("To: b@corp.example.com, c@corp.example.com", "Subject: text", "X-cc: d", "X-bcc: e", body="body\nlines\n")
    [row] = parse(raw)
    assert row.asDict() == {
        "path": "000",
        "from": "a@corp.example.com",
        "ts": TS,
        "mid": "ab",
        "to": "b@corp.example.com, c@corp.example.com",
        "subject": "text",
        "cc": "e",
        "bcc": None,
        "body": " body lines ",
        "reason": None,
    }
    [row] = parse(raw, profile=messages.INTENDED)
    assert (row["mid"], row["cc"], row["bcc"]) == ("abc", "d", "e")


def test_rejects(parse):
    no = lambda prefix: [line for line in BASE if not line.startswith(prefix)]
    rows = parse(
        text(base=no("Date")),
        text(base=[*no("Date"), "Date: Mon, 14 May 2001 16:39:00 -0700"]),
        text(base=no("Message-ID")),
        text(base=[*no("Message-ID"), "Message-ID: <>"]),
        text(base=no("From")),
        text(base=no("Nothing")),
        "",
        "\n",
        "\n" + text(),
    )
    assert [r["reason"] for r in rows] == [
        "no_date",
        "bad_date",
        "no_id",
        "bad_id",
        "no_from",
        None,
        "no_date",
        "no_date",
        "no_date",
    ]


def test_message_ids(parse):
    base = BASE[1:]
    ids = ["<abc>", "abc", "<a>", "<abc", "<", ">"]
    raws = [text(base=[*base, f"Message-ID: {i}"]) for i in ids]
    assert [r["mid"] for r in parse(*raws)] == ["ab", "abc", "", "<abc", "<", ">"]
    assert [r["mid"] for r in parse(*raws, profile=messages.INTENDED)] == ["abc", "abc", "a", "<abc", "<", ">"]


def test_headers(parse):
    rows = parse(
        text("To:", "To: x", "To: y"),
        text("to: x"),
        text("To : x"),
        text(" To: x"),
        text(" ", "To: x"),
        text("no header", "To:x:y"),
        text("To: \t x \t"),
        text("Cc: c"),
        text("XTo: x"),
        text("To: x", body="To: y\n"),
        text(body="To: y\n"),
    )
    assert [r["to"] for r in rows] == ["x", None, None, None, "x", "x:y", "x", None, None, "x", None]
    assert rows[7]["cc"] is None


def test_wrapped_lines(parse):
    raws = [
        text("To: x,", "\ty"),
        text("Subject: a", " To: y"),
        text("To: x,", "\ty", " z", "Subject: s"),
    ]
    rows = parse(*raws)
    assert [(r["to"], r["subject"]) for r in rows] == [("x,", None), (None, "a"), ("x,", "s")]
    rows = parse(*raws, profile=messages.INTENDED)
    assert [(r["to"], r["subject"]) for r in rows] == [("x,\ty", None), (None, "a To: y"), ("x,\ty z", "s")]


def test_bodies(parse):
    rows = parse(
        text(),
        text(body=""),
        text(body="\n\n"),
        text(body="Don't  stop\n_x_!"),
        text(body="x"),
        text(body="x\n\n\n"),
        text(body="  \n"),
        text(body="don’t"),
        text(body="a\n\nb\n"),
    )
    assert [r["body"] for r in rows] == ["", "", "", " Dont stop _x_ ", " x ", " x ", " ", " don t ", " a b "]


def test_line_ends(parse):
    raw = text("To: x", body="one\n\ntwo\n")
    rows = parse(raw, raw.replace("\n", "\r\n"), raw.replace("\n", "\r"))
    expected = {k: v for k, v in rows[0].asDict().items() if k != "path"}
    for row in rows[1:]:
        assert {k: v for k, v in row.asDict().items() if k != "path"} == expected


def test_only_line_feeds_end_lines(parse):
    [row] = parse(text("Subject: a\x85To: x From: y", body="z"))
    assert row["subject"] == "a\x85To: x From: y"
    assert row["to"] is None


def test_random_messages_against_a_line_by_line_rule(parse):
    picker = random.Random(4)
    lines = [
        "To: x", "To:", "To:  \t", "To: y z ", " To: no", "to: no", "Subject: s:t", "Subject:\tq", "X-cc: c",
        "X-bcc: b", "X-bcc:", "X-cc", "", "", " ", "\t", "it's text", "From: late@x", "a_b  c", "é: è",
    ]
    raws = []
    for _ in range(300):
        parts = picker.choices(lines, k=picker.randint(0, 12))
        for line in BASE:
            parts.insert(picker.randint(0, min(3, len(parts))), line)
        raws.append("\n".join(parts) + picker.choice(["", "\n", "\n\n"]))

    def rule(raw):
        head, found = [], {}
        every = raw.rstrip("\n").split("\n")
        while every and every[0] != "":
            head.append(every.pop(0))
        for line in head:
            name, colon, value = line.partition(":")
            value = value.strip(" \t")
            if colon and value and name not in found:
                found[name] = value
        body = "".join(line + "\n" for line in every) if "".join(every) else ""
        body = re.sub(r"[^A-Za-z0-9_]+", " ", body.replace("'", ""))
        missing = [
            reason
            for name, reason in [("Date", "no_date"), ("Message-ID", "no_id"), ("From", "no_from")]
            if name not in found
        ]
        cc = found.get("X-bcc", found.get("X-cc"))
        return found.get("From"), found.get("To"), found.get("Subject"), cc, body, (missing or [None])[0]

    got = [tuple(r[c] for c in ["from", "to", "subject", "cc", "body", "reason"]) for r in parse(*raws)]
    assert got == [rule(raw) for raw in raws]
    assert {g[-1] for g in got} == {None, "no_date", "no_id", "no_from"}


def test_tally(spark):
    frame = spark.createDataFrame([("a", text()), ("b", "junk")], "path string, value string")
    assert messages.import_tally(messages.parse_messages(frame)).first().asDict() == {
        "files": 2,
        "parsed": 1,
        "rejected": 1,
    }


def test_import_merges_cell_by_cell(spark):
    first = text("To: x", "Subject: one", body="first")
    second = text("Subject: two", body="second")
    frame = spark.createDataFrame([("b", second), ("a", first), ("c", "junk")], "path string, value string")
    table, rejects = mail_import.import_messages(frame)
    assert [r.asDict() for r in table.collect()] == [
        {
            "from": "a@corp.example.com",
            "ts": TS,
            "mid": "ab",
            "date": TS,
            "to": "x",
            "subject": "two",
            "cc": None,
            "bcc": None,
            "body": " second ",
        }
    ]
    assert [tuple(r) for r in rejects.collect()] == [("c", "no_date")]
    again, _ = mail_import.import_messages(frame.union(frame))
    assert again.collect() == table.collect()


def test_targets(spark):
    frame = spark.createDataFrame([("a", text())], "path string, value string")
    table, _ = mail_import.import_messages(frame, "employee")
    assert table.columns[:2] == ["employee", "ts"]
    assert table.first()["from"] == "a@corp.example.com"
    with pytest.raises(ValueError):
        mail_import.import_messages(frame, "other")
    with pytest.raises(ValueError):
        messages.parse_messages(frame, "other")


def test_headers_and_dates_are_parsed_once(spark):
    frame = spark.createDataFrame([("a", text())], "path string, value string")
    table, rejects = mail_import.import_messages(frame)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\n)From:") == 1
    assert "Python" not in plan
    plan = rejects._jdf.queryExecution().optimizedPlan().toString()
    assert r"\W+" not in plan and r"\n)To:" not in plan
