"""Token counts through a digest cache.

A cache row is (tokenizer digest, content digest, bytes, tokens). The tokenizer
digest covers the model file and the library's version; the content digest is
the SHA-256 of the text (null read as empty; no other normalisation, since any
would change counts). Content digests are joined to the stored counts, only
distinct misses are encoded, and their counts are appended to the cache.

The cache is a folder of Parquet folders, one for each run that added counts.
By default it lies in the shared folder, under the tokenizer's digest, and
outlives the run. A run writes a folder of its own, so runs may append at the
same time; a digest that two runs added counts once. ``compact`` rewrites a cache as one folder.

Copies are dropped within each scan task before the shuffle, so a group of
copies that holds a third of all rows sends one text per task. On the way back
from the counts to the rows, digests that hold over a thousandth of all rows -
fewer than a thousand, whatever the input - are answered by a broadcast and their rows are
spread by id; no other digest can fill a task.

Within a text, distinct chunks are encoded once: a piece of the vocabulary that
holds the space mark anywhere but at its start is made of space marks only
(checked when the model is loaded; otherwise whole texts are encoded), so the
tokens of a text are those of its chunks, each a run of spaces with the word
after it. A text that holds the space mark itself is encoded whole.

Defined cases: a null or empty text has 0 bytes and 0 tokens. A null ``doc_id``
and repeated rows are counted like any other row. An empty table gives an empty
result and leaves the cache as it is. A text of any length is encoded whole.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crownlake.llm.chunks import distinct_chunks, lookup, sums
from crownlake.llm.common import exists, prepare, shuffle_partitions, stored, texts
from crownlake.session import ensure_checkpoint_dir

CACHE = "tokenizer string, digest binary, n_bytes bigint, n_tokens bigint"
SPACE_MARK = "▁"
METHOD = 2  # to be raised when counts of the same library and model change
HOT_ROWS, HOT_SHARE = 1000, 1000
# A chunk starts at a space that follows something else; that space is the model's own leading mark.
BORDER = re.compile(r"(?<=[^ ]) ")

_loaded: dict[str, tuple] = {}


def tokenizer_digest(model_path: str) -> str:
    import sentencepiece

    with open(model_path, "rb") as f:
        return hashlib.sha256(f.read() + sentencepiece.__version__.encode()).hexdigest()


def _model(path: str) -> tuple:
    """The model, whether its texts may be cut, and this worker's memo of chunk counts."""
    if path not in _loaded:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (model.id_to_piece(i) for i in range(model.vocab_size()))
        cuttable = not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces) and len(model.encode(" a")) == len(model.encode("a  a")) - len(model.encode("a"))
        _loaded[path] = (model, cuttable, {})
    return _loaded[path]


def count_batch(path: str, batch: pa.Array) -> np.ndarray:
    """Tokens of each text of a string array without nulls."""
    model, cuttable, memo = _model(path)
    if not len(batch):
        return np.zeros(0, np.int64)

    def counts(values: list[str]) -> list[int]:
        return [len(x) for x in model.encode(values, num_threads=1)]

    if not cuttable:
        return np.array(counts(batch.to_pylist()), np.int64)
    # A text in which no space meets another or an end splits at each space; the rest split at BORDER.
    odd = pc.match_substring_regex(batch, "^ |  | $").to_numpy(zero_copy_only=False)
    marked = pc.match_substring(batch, SPACE_MARK).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(pc.if_else(pa.array(odd | marked), "", batch), " ")
    chunks, index, offsets = distinct_chunks(lists)
    out = sums(np.array(lookup(chunks, memo, counts), np.int64)[index], offsets)
    if marked.any():
        out[marked] = counts(batch.filter(pa.array(marked)).to_pylist())
    for i in np.flatnonzero(odd & ~marked):
        parts = BORDER.split(batch[int(i)].as_py())
        out[i] = sum(lookup(parts, memo, counts)) + (len(parts) > 1 and parts[-1] == "")
    return out


def _local_distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each digest in this task."""
    seen: set[bytes] = set()
    for batch in batches:
        digests = batch.column("digest").to_pylist()
        keep = []
        for d in digests:
            keep.append(d not in seen)
            seen.add(d)
        yield batch.filter(pa.array(keep))


def _encode(path: str, version: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _local_distinct(batches):  # all rows of a digest are in this partition
            words = batch.column("text")
            yield pa.RecordBatch.from_pydict(
                {
                    "tokenizer": pa.array([version] * len(words), pa.string()),
                    "digest": batch.column("digest").cast(pa.binary()),
                    "n_bytes": pc.binary_length(words).cast(pa.int64()),
                    "n_tokens": pa.array(count_batch(path, words), pa.int64()),
                }
            )

    return run


def default_cache(spark: SparkSession, version: str) -> str:
    """The cache of one tokenizer and this way of counting, in the folder that all machines share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-counts/{version}-{METHOD}"


def read_cache(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer, one row per digest even if two runs appended the same one."""
    if not exists(spark, cache_path):
        return spark.createDataFrame([], CACHE).drop("tokenizer")
    rows = spark.read.schema(CACHE).option("recursiveFileLookup", "true").parquet(cache_path).where(F.col("tokenizer") == version)
    return rows.groupBy("digest").agg(F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens"))


def append_to_cache(counts: DataFrame, cache_path: str) -> None:
    """Add rows as a folder of their own."""
    counts.write.parquet(f"{cache_path.rstrip('/')}/run-{uuid.uuid4().hex}")


def compact(spark: SparkSession, cache_path: str, version: str) -> None:
    """Rewrite what the cache holds of one tokenizer as one folder, then drop the folders it came from.

    Runs may append meanwhile; a run that reads meanwhile may have to be repeated.
    """
    if not exists(spark, cache_path):
        return
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache_path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [s.getPath() for s in fs.listStatus(folder)]
    rows = spark.read.schema(CACHE).parquet(*[p.toString() for p in old])
    append_to_cache(rows.groupBy("tokenizer", "digest").agg(F.max("n_bytes").alias("n_bytes"), F.max("n_tokens").alias("n_tokens")), cache_path)
    for path in old:
        fs.delete(path, True)


def hot_digests(rows: DataFrame) -> DataFrame:
    """Digests of more than a thousandth of all rows (and over a thousand rows): fewer than a thousand of them."""
    least = max(HOT_ROWS, rows.count() // HOT_SHARE)
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least).select("digest")


def count_tokens(docs: DataFrame, model_path: str, cache_path: str | None = None, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row; ``cache_path`` is a folder that outlives the run."""
    spark = docs.sparkSession
    prepare(spark)
    version = tokenizer_digest(model_path)
    cache_path = cache_path or default_cache(spark, version)
    keyed = texts(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))
    unique = keyed.select("digest", "text").mapInArrow(_local_distinct, "digest binary, text string")
    known = read_cache(spark, cache_path, version).select("digest")
    misses = unique.join(known, "digest", "left_anti").repartition(shuffle_partitions(spark), "digest")
    append_to_cache(misses.mapInArrow(_encode(model_path, version), CACHE), cache_path)
    # From here on only digests and ids move, written once.
    rows = stored(keyed.select("doc_id", "digest"), "digests")
    counts = read_cache(spark, cache_path, version)
    hot = counts.join(F.broadcast(hot_digests(rows)), "digest").select(
        F.col("digest").alias("hot"), F.col("n_bytes").alias("hot_bytes"), F.col("n_tokens").alias("hot_tokens")
    )
    met = rows.join(F.broadcast(hot), F.col("digest") == F.col("hot"), "left")
    by_id = F.unhex(F.md5(F.coalesce("doc_id", F.lit(0)).cast("string").cast("binary")))  # 16 bytes: equals no digest
    spread = met.withColumn("digest", F.when(F.col("hot").isNull(), F.col("digest")).otherwise(by_id))
    found = spread.join(counts, "digest", "left")
    n_tokens = F.coalesce("hot_tokens", "n_tokens")
    n_bytes = F.coalesce("hot_bytes", "n_bytes")
    return found.select("doc_id", n_bytes.alias("n_bytes"), n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))
