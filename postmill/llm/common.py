"""Small helpers that the operators share."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_FOLDERS: dict[str, list[str]] = {}

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which every executor can reach.

    Only in a local session without that setting, as in tests, the warehouse folder
    takes its place; elsewhere ``ValueError`` is raised.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/postmill-{uuid.uuid4().hex}"
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def clear_shared(spark: SparkSession) -> None:
    """Deletes the tables that this session's operators have stored between their steps.

    Results that have not been stored elsewhere can't be computed after that.
    """
    for folder in _FOLDERS.pop(spark.sparkContext.applicationId, []):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors.

    The files belong to the run; :func:`clear_shared` deletes them when it has ended.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run inside hands Python at most ``rows`` rows at a time; a lower setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the workers this package, once a session: a small zip file in the shared folder,
    handed out by Spark's own file service."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    # Its folder is not cleared: executors that join later fetch it, too.
    folder = shared_folder(spark)
    _FOLDERS[context.applicationId].remove(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{root.name}.zip")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(path)
    stream.write(packed.getvalue())
    stream.close()
    context.addPyFile(system.makeQualified(path).toString())
    _SHIPPED.add(context.applicationId)


def append_columns(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], list[pa.Array]],
    fields: list[T.StructField],
    parts: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]] | None = None,
) -> DataFrame:
    """``df`` and new columns that ``function`` makes of each Arrow batch, or of each of the
    ``parts`` that a batch is cut into, which are then given out one by one.

    A column of ``df`` with the name of a new one is replaced.
    """
    ship_package(df.sparkSession)
    names = {field.name.lower() for field in fields}
    kept = df.select(*[f"`{c}`" for c in df.columns])
    old = [field for field in kept.schema.fields if field.name.lower() not in names]
    schema = T.StructType(old + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in (parts(batch) if parts else (batch,))):
            made = function(batch)
            columns = [batch.column(batch.schema.get_field_index(field.name)) for field in old]
            yield pa.RecordBatch.from_arrays(columns + made, names=schema.names)

    return kept.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (UTF-8) of a string or binary column and the n + 1 places where its values
    begin; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)
