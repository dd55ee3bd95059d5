"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crownlake.session import path_bytes, scratch_path

# Rows of one Arrow batch: texts of some kilobytes keep a batch at a few megabytes.
BATCH_ROWS = 2048
BATCH_BYTES = 8 * 1024 * 1024
PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches, so that one batch of long texts fits a Python worker, and let workers import this package.

    Where machines don't share the package's folder, ship it with ``--py-files`` as well.
    """
    environment = spark.sparkContext.environment
    if PACKAGE_ROOT not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = f"{PACKAGE_ROOT}:{environment.get('PYTHONPATH', '')}".rstrip(":")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and whole ``text`` (null reads as empty); any other column is left behind."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` under the shared folder and read it back: lineage ends here, lost executors cost nothing before it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, giving freed memory back after each batch: a worker outlives its task, and its idle memory counts."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch
            pa.default_memory_pool().release_unused()
        pa.default_memory_pool().release_unused()
        if trim := _trim():
            trim(0)

    return wrapped


def exists(spark: SparkSession, path: str) -> bool:
    return path_bytes(spark, path) > 0


def utf8_bytes(texts_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without nulls as one buffer, and the n+1 offsets into it (no copy)."""
    if pa.types.is_large_string(texts_.type):
        kind = np.int64
    else:
        kind = np.int32
    buffers = texts_.buffers()
    n = len(texts_)
    offsets = np.frombuffer(buffers[1], dtype=kind)[texts_.offset : texts_.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if n else data[:0], offsets - (offsets[0] if n else 0)


def filled(texts_: pa.Array) -> pa.Array:
    """A string array with nulls read as empty texts."""
    return texts_.fill_null("") if texts_.null_count else texts_


# Bits of the filter below: one megabyte in 64-bit words, whatever the input.
FILTER_BITS = 1 << 23


def possibly_in(docs: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` may be in ``ids[column]``: all that are, few others while the filter is sparse.

    A bit per hash, joined as at most 131,072 words, so rows that no join would keep need not be shuffled for it.
    Very many ids fill the filter; it then passes more rows and nothing else changes.
    """

    def slot(c) -> F.Column:
        return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))

    bits = (
        ids.select(slot(F.col(column).cast("long")).alias("__slot"))
        .groupBy(F.floor(F.col("__slot") / 64).cast("int").alias("__word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("__slot") % 64).cast("int"))).alias("__bits"))
    )
    own = slot(F.col("doc_id").cast("long"))
    met = docs.join(F.broadcast(bits), F.floor(own / 64).cast("int") == F.col("__word"))
    return met.where(F.getbit("__bits", (own % 64).cast("int")) == 1).drop("__word", "__bits")
