"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs are its runs between line ends and stops; the set of their
64-bit digests goes into a table of cells, each digest into three cells, where a
cell keeps a count, the xor of its digests and the xor of their check sums. Two
tables of one size subtract cell by cell, what both texts have vanishes, and
peeling cells that hold a single digest recovers the digests of only one side.
If that fails, both texts are sketched again with four times the cells, until
it succeeds. From the sizes of both sets and the recovered difference follows
the exact Jaccard likeness of the two digest sets.

``edit_report`` compares each document with the next one by id and with an edit
of itself. Rows are dealt by ranges of the id, one to a task; the first row of
a range also goes to the range before it, so each task reads its documents in
order. Texts are shuffled once. The ranges come from a range partitioning of
the ids alone, whose first keys are broadcast: one number per partition.

Defined cases: null text is empty text. Two empty sets are alike (1), an empty
and another one are not (0). Null ids come first in the order; rows with one id
are ordered by a hash of their text. A single row is its own next document. An
empty table gives an empty result. Texts of any length are read whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownlake.llm.common import lean, prepare, shuffle_partitions, texts

HASHES = 3
CELLS = 24
GROWTH = 4
BLOCK = 256
# Cells of the grown tables that a worker holds at a time: as many as a block's first ones, or one text's.
LIVE_CELLS = BLOCK * CELLS
PARAGRAPH = re.compile(r"[^\n.,;:!?|]+")
NULL_KEY = -(1 << 63)

# Odd constants of a 64-bit mixing function; the first three place a digest, the last one gives its check sum.
SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)

REPORT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def paragraph_digests(text: str) -> np.ndarray:
    """Distinct 64-bit digests of the paragraphs of a text."""
    parts = {p.strip() for p in PARAGRAPH.findall(text)}
    parts.discard("")
    return np.fromiter((xxhash.xxh3_64_intdigest(p) for p in parts), np.uint64, len(parts))


def mix(digests: np.ndarray, which: int) -> np.ndarray:
    z = (digests ^ (digests >> np.uint64(31))) * SEEDS[which]
    z = (z ^ (z >> np.uint64(29))) * SEEDS[which]
    return z ^ (z >> np.uint64(32))


class Sketches:
    """Tables of ``cells`` cells, one row a text."""

    def __init__(self, sets: list[np.ndarray], cells: int) -> None:
        self.cells, self.sizes = cells, np.array([len(s) for s in sets], np.int64)
        shape = (len(sets), cells)
        self.count, self.keys, self.checks = np.zeros(shape, np.int64), np.zeros(shape, np.uint64), np.zeros(shape, np.uint64)
        if sets:
            of = np.repeat(np.arange(len(sets)), self.sizes)
            self.toggle(of, np.concatenate(sets), 1)

    def toggle(self, rows: np.ndarray, digests: np.ndarray, change: np.ndarray | int) -> None:
        """Xor digests into (or out of) their cells and change the cells' counts."""
        check, width = mix(digests, HASHES), self.cells // HASHES
        for j in range(HASHES):
            at = (rows, j * width + (mix(digests, j) % np.uint64(width)).astype(np.int64))
            np.add.at(self.count, at, change)
            np.bitwise_xor.at(self.keys, at, digests)
            np.bitwise_xor.at(self.checks, at, check)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches([], self.cells)
        out.count, out.keys, out.checks = self.count - other.count, self.keys ^ other.keys, self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each row: digests only in the minuend, only in the subtrahend, and whether all were recovered. Empties the table."""
        more, less = np.zeros(len(self.count), np.int64), np.zeros(len(self.count), np.int64)
        for _ in range(4 * self.cells):
            rows, cells = np.nonzero(np.abs(self.count) == 1)
            pure = self.checks[rows, cells] == mix(self.keys[rows, cells], HASHES)
            rows, cells = rows[pure], cells[pure]
            if not len(rows):
                break
            found = np.empty(len(rows), [("row", np.int64), ("key", np.uint64)])
            found["row"], found["key"] = rows, self.keys[rows, cells]
            _, first = np.unique(found, return_index=True)
            rows, cells = rows[first], cells[first]
            signs, digests = self.count[rows, cells], self.keys[rows, cells]
            np.add.at(more, rows[signs > 0], 1)
            np.add.at(less, rows[signs < 0], 1)
            self.toggle(rows, digests, -signs)
        return more, less, ~(self.count.any(axis=1) | self.keys.any(axis=1))

    def text(self, row: int) -> str:
        """The fingerprint: set size and cells in base64."""
        raw = struct.pack("<q", int(self.sizes[row])) + self.count[row].astype("<i4").tobytes() + self.keys[row].astype("<u8").tobytes()
        return base64.b64encode(raw + self.checks[row].astype("<u8").tobytes()).decode()


def likeness(left: list[np.ndarray], right: list[np.ndarray], first: tuple[Sketches, Sketches] | None = None) -> np.ndarray:
    """Jaccard likeness of each pair of digest sets, by subtracting and peeling sketches of growing size."""
    out = np.ones(len(left))
    open_, cells = np.arange(len(left)), CELLS
    while len(open_):
        left_over, step = [], max(1, LIVE_CELLS // cells)
        for at in range(0, len(open_), len(open_) if first else step):
            rows = open_ if first else open_[at : at + step]
            a, b = first or (Sketches([left[i] for i in rows], cells), Sketches([right[i] for i in rows], cells))
            more, less, done = a.minus(b).peel()
            union = a.sizes + less
            out[rows[done]] = ((a.sizes - more) / np.maximum(union, 1) + (union == 0))[done]
            left_over.append(rows[~done])
        open_, cells, first = np.concatenate(left_over), cells * GROWTH, None
    return out


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as many first characters of the following one, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(rows: list[tuple[int | None, str, np.ndarray, str, np.ndarray]]) -> pa.RecordBatch:
    """Report of (id, text, digests, following text, its digests)."""
    changed = [edited(text, following) for _, text, _, following, _ in rows]
    own, next_ = [r[2] for r in rows], [r[4] for r in rows]
    changed_sets = [paragraph_digests(t) for t in changed]
    a, b, c = Sketches(own, CELLS), Sketches(changed_sets, CELLS), Sketches(next_, CELLS)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([r[0] for r in rows], pa.int64()),
            "n_chars": pa.array([len(r[1]) for r in rows], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            "fingerprint": pa.array([a.text(i) for i in range(len(rows))], pa.string()),
            "edited_fingerprint": pa.array([b.text(i) for i in range(len(rows))], pa.string()),
            "near_edited": pa.array(likeness(own, changed_sets, (a, b))),
            "near_next": pa.array(likeness(own, next_, (a, c))),
        }
    )


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pair each row with its follower in the range; rows come ordered, a range's follower last."""

    def pairs():
        held = None
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("doc_id", "text", "range", "after")]
            for doc_id, text, range_, after in zip(*columns):
                if after and (held is None or held[3] != range_):
                    continue  # a second row with the follower's id
                row = (doc_id, text, paragraph_digests(text), range_)
                if held is not None and held[3] == range_:
                    yield (*held[:3], row[1], row[2])
                held = None if after else row

    rows = pairs()
    while block := list(islice(rows, BLOCK)):
        yield _compare(block)


def _ranges(starts: Broadcast) -> Callable:
    """Ranges that a key's row goes to: its own one and, for the first key of a range, the one before it in the ring."""

    @F.arrow_udf("array<struct<range int, after boolean>>")
    def to(keys: pa.Array) -> pa.Array:
        firsts, k = starts.value, keys.to_numpy()
        own = np.searchsorted(firsts, k, side="right") - 1
        leads = firsts[own] == k
        ends = np.cumsum(1 + leads)
        range_, after = np.repeat(own, 1 + leads), np.zeros(ends[-1] if len(ends) else 0, bool)
        second = ends[leads] - 1
        range_[second] = (own[leads] - 1) % len(firsts)
        after[second] = True
        pairs = pa.StructArray.from_arrays([pa.array(range_, pa.int32()), pa.array(after)], ["range", "after"])
        return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pairs)

    return to


def _starts(keys: DataFrame, ranges: int) -> np.ndarray:
    """The least key of each of about equal ranges: Spark's range partitioning of the keys alone gives them."""
    dealt = keys.repartitionByRange(ranges, "key")
    least = dealt.groupBy(F.spark_partition_id().alias("range")).agg(F.min("key").alias("first")).select("first")
    return np.sort(least.toArrow()["first"].to_numpy())


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(NULL_KEY))


def edit_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row."""
    spark = docs.sparkSession
    prepare(spark)
    keys = docs.select(_key(F.col("doc_id").cast("long")).alias("key"))
    starts = _starts(keys, shuffle_partitions(spark))  # a number per partition, as Spark's own bounds are
    to = _ranges(spark.sparkContext.broadcast(starts))
    dealt = texts(docs).withColumn("key", _key(F.col("doc_id")))
    dealt = dealt.withColumn("to", F.explode(to("key"))).select("doc_id", "text", "key", "to.range", "to.after")
    ordered = dealt.repartitionById(max(1, len(starts)), "range").sortWithinPartitions("range", "after", "key", F.xxhash64("text"))
    return ordered.select("doc_id", "text", "range", "after").mapInArrow(lean(_in_order), REPORT)
