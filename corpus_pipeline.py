"""Documents to training sequences, stage by stage.

Each stage is stored in the folder that the cluster's executors share, and read again
by the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import decontamination, packing, quality, secret_scans, simhash
from postmill.llm.common import read_table, written
from postmill.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    A null text is scored as an empty one; repeated rows are kept or dropped together, an
    empty table stays empty, and columns of any name stay as they are.
    """
    model = quality.fit_model(docs, read_table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of linked fingerprints.

    Shingles of three words, two differing bits: what ``simhash`` takes by default.  Null and
    empty texts are linked with each other.  A document without an id stays only where its
    group has no id at all; of repeated rows one stays.  An empty table stays empty, and
    columns of any name stay as they are.
    """
    return simhash.one_of_each(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Null and empty texts stay, and so does every document if the benchmark is empty.
    Repeated rows stay or go together; columns of any name stay as they are.
    """
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask in the place of each secret; ``n_chars`` is that of the text.

    A null text stays null, with a null ``n_chars``; repeated rows are masked alike, an empty
    table stays empty, and other columns of any name stay as they are.
    """
    masked = secret_scans.mask_documents(docs, secret_scans.scan_new(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths, with the document and place they come from.

    A null or empty text is the separator alone; repeated rows are packed each, and an empty
    table gives no rows.  Other columns of the documents are not read.
    """
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path()).select(
        "sequence_id", "bucket", "doc_id", "start", "length", "offset", "doc_tokens", "ids"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_near_copies),
    ("decontamination", keep_uncontaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: No SQL: a trained model, hashes and a tokenizer are not expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
