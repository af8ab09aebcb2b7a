"""Registered queries of the subpackage: thin contracts over the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import (
    alignment,
    ball_tree,
    decontamination,
    divergence,
    licenses,
    packing,
    pages,
    quality,
    secret_scans,
    shards,
    simhash,
    suffix_dedup,
    urls,
)
from postmill.llm.common import read_table, written

URL_RULES = [
    urls.host_rule("allow", "org/"),
    urls.host_rule("block", "example.org/es/"),
    urls.host_rule("block", "example.org/en/1"),
    urls.host_rule("allow", "com/fr/"),
    urls.host_rule("block", "com/de/"),
]
SHARDS = 8


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urls.judge(source, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    spread = shards.hot_hashes(docs)
    mapping = shards.balance(shards.collect_sizes(docs, spread=spread), SHARDS)
    assigned = shards.assign(docs, mapping, version=1, spread=spread)
    narrow = written(assigned.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")))).drop("text"))
    return shards.with_positions(narrow).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("position").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scans.with_findings(docs, secret_scans.scan_new(docs))
    base = [rule.kind for rule in secret_scans.BASE_RULES]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(secret_scans.listed(F.filter("spans", lambda s: s["rank"] < len(base))), 256).alias("base_sha256"),
        secret_scans.listed(F.col("spans")).alias("spans"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer_path()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.with_matches(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["length"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_model(docs, read_table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", ball_tree.whole_numbers(F.col("embedding")).alias("embedding")
    )
    return ball_tree.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, span: n + span["length"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.size("removed") > 0).alias("repeated"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_groups(docs).select(
        "doc_id", simhash.hex_digits(F.col("simhash")).alias("fingerprint"), "component_id"
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pages.with_main_text(source).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = alignment.align(docs, tokenizer_path(), piece_model_path())
    # The groups' text is digested before anything is stored.
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    digested = aligned.select("doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "links")
    return alignment.with_link_counts(digested).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.filter("found", lambda f: f["base"])

    def labels(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda f: f["label"]))), ",")

    return licenses.scan(docs).select(
        "doc_id",
        "n_words",
        F.aggregate(base, F.lit(0).cast("long"), lambda n, f: n + f["places"]).alias("n_base"),
        F.array_min(F.transform(base, lambda f: f["first_word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda f: f["last_word"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["score"])), F.lit(0.0)).alias("score"),
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter,
        op2_slot_shards,
        op3_secret_scan,
        op4_packing,
        op5_decontamination,
        op6_quality,
        op7_top_k,
        op8_suffix_dedup,
        op9_simhash,
        op10_html_extraction,
        op11_token_alignment,
        op12_license_scan,
        op13_source_divergence,
    )
}
