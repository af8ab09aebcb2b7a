from __future__ import annotations

import random

from pyspark.sql import functions as F

from postmill.llm import queries, secret_scans
from tests.conftest import SMALL
from tests.llm import brute

ODD = [
    None, "", "token=abc", "secret=token:abcdefgh", "PassWord = 'hunter22'", "api_key:\t123456", "apikey\": \"a.b-c=d/e+f\"",
    "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 30, "0" * 23, "0" * 24 + "g" + "f" * 50, "token=" + "a" * 30,
    "é😀 secret=é secret=abcdef", "ſecret=abcdef", "toKen=abcdefg", "password==abcdef", "password=\"\"abcdef",
    "x" * 200_000 + " token: abcdefgh " + "0123456789abcdef" * 4, "token=abcdef token=abcdef", "-----BEGIN RSA PRIVATE KEY-----",
]


def scanned(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return secret_scans.with_findings(docs, secret_scans.scan_new(docs))


def base_digest(frame):
    base = F.filter("spans", lambda s: s["rank"] < len(secret_scans.BASE_RULES))
    return frame.select("doc_id", F.sha2(secret_scans.listed(base), 256).alias("sha")).collect()


def test_odd_texts(spark):
    rows = base_digest(scanned(spark, list(enumerate(ODD))))
    assert len(rows) == len(ODD)
    for row in rows:
        assert row["sha"] == brute.secrets(ODD[row["doc_id"]])[1], ODD[row["doc_id"]]


def test_made_up_texts(spark):
    rng = random.Random(3)
    parts = ["token", "secret", "PASSWD", "api_key", "=", ":", " ", "'", '"', "abcdef", "AKIA", "Z9" * 9, "0f" * 13, "é", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(400)]
    for row in base_digest(scanned(spark, list(enumerate(texts)))):
        assert row["sha"] == brute.secrets(texts[row["doc_id"]])[1], texts[row["doc_id"]]


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = queries.op3_secret_scan(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        counts, digest = brute.secrets(texts[r["doc_id"]])
        assert ((r["n_assign"], r["n_access"], r["n_hex"]), r["base_sha256"]) == (counts, digest)


def test_only_unseen_pairs_are_scanned(spark):
    first = spark.createDataFrame([(1, "token=abcdefgh"), (2, "token=abcdefgh"), (3, "none")], "doc_id long, text string")
    ledger = secret_scans.scan_new(first)
    assert ledger.count() == 2
    later = spark.createDataFrame([(4, "token=abcdefgh"), (5, "secret: xyzxyz")], "doc_id long, text string")
    new = secret_scans.scan_new(later, ledger)
    assert [r["blob"] for r in new.collect()] == [brute.sha("secret: xyzxyz")]
    assert secret_scans.scan_new(later, ledger, rule_version="2").count() == 2
    both = ledger.unionByName(new)
    found = secret_scans.with_findings(first.union(later), both).collect()
    assert {r["doc_id"]: len(r["spans"]) for r in found} == {1: 1, 2: 1, 3: 0, 4: 1, 5: 1}


def test_masking_clashes_and_empty_table(spark):
    frame = scanned(spark, [(1, "a token=abcdefgh b"), (2, None), (3, "plain")])
    out = {r[0]: r[1] for r in frame.select("doc_id", secret_scans.masked(F.col("text"), F.col("spans"))).collect()}
    assert out == {1: "a [SECRET] b", 2: None, 3: "plain"}
    clash = spark.createDataFrame([(1, "x", "mine", "b")], "doc_id long, text string, spans string, blob string")
    row = secret_scans.with_findings(clash, secret_scans.scan_new(clash)).first()
    assert row["spans"] == [] and row["blob"] == "b"
    empty = clash.limit(0)
    assert secret_scans.with_findings(empty, secret_scans.scan_new(empty)).collect() == []


def test_spans_that_overlap_are_masked_once(spark):
    text = "token=" + "0123456789abcdef" * 2 + " end"
    frame = scanned(spark, [(1, text)])
    assert frame.select(secret_scans.masked(F.col("text"), F.col("spans"))).first()[0] == "[SECRET] end"


KEY = [("MIIEpAIBAAKCAQEA" + "k3Y/Body+" * 9)[:64]] * 6 + ["dGhlIGVuZA=="]
BEGIN, END = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
LONG_WORD = "p" * 300
KEPT = [
    # text, masked
    ("a\n" + "\n".join([BEGIN, *KEY, END]) + "\nb", "a\n[SECRET]\nb"),
    ("a\r\n" + "\r\n".join([BEGIN, "Proc-Type: 4,ENCRYPTED", "DEK-Info: X,0A", "", *KEY, END]) + " b", "a\r\n[SECRET] b"),
    ('{"key": "' + "\\n".join([BEGIN, *KEY, END]) + '\\n"}', '{"key": "[SECRET]\\n"}'),
    ("\n".join([BEGIN, *KEY]) + "\nThe text goes on here.", "[SECRET]\nThe text goes on here."),
    ("\n".join([BEGIN, *KEY[:3]]) + "\nk3Y/B", "[SECRET]"),
    ("\n".join([BEGIN, *KEY, "", BEGIN, *KEY, END, "c"]), "[SECRET]\n\n[SECRET]\nc"),
    ("-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: 1\n\n" + KEY[0] + "\n=aB3d\n-----END PGP PRIVATE KEY BLOCK-----.", "[SECRET]."),
    (f"A file begins with {BEGIN} and so on - and on.", "A file begins with [SECRET] and so on - and on."),
    (f"redis://:{LONG_WORD}@host", "[SECRET]host"),
    (f"https://{LONG_WORD}:{LONG_WORD}@host/x", "[SECRET]host/x"),
    ("see http://host:8080/a and me@host", "see http://host:8080/a and me@host"),
]


def test_whole_keys_and_long_credentials_are_masked(spark):
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(KEPT)], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in secret_scans.mask_documents(docs, secret_scans.scan_new(docs)).collect()}
    assert [out[i] for i in range(len(KEPT))] == [masked for _, masked in KEPT]


def test_long_texts_after_a_marker_end(spark):
    texts = [BEGIN + "-x" * 200_000, BEGIN + "- " * 200_000 + END, BEGIN * 20_000, BEGIN + ("\n" + "Ab" * 32) * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in secret_scans.mask_documents(docs, secret_scans.scan_new(docs)).collect()}
    assert out == {0: "[SECRET]" + "-x" * 200_000, 1: "[SECRET]", 2: "[SECRET]" * 20_000, 3: "[SECRET]"}
