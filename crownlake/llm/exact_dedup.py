"""Exact dedup by an exchange of Golomb-coded fingerprints.

Every scan partition hashes its texts (A-Z lower-cased, null read as empty) and
sends the sorted distinct fingerprints of each owner's range as Golomb-Rice
coded gaps. An owner merges the lists that it got and answers each sender with
a bitmap of the fingerprints that occur more than once. Only rows with a marked
fingerprint are suspects; their whole texts are shuffled and grouped by their
bytes, which decides. The coded lists are a table in the shared folder, with
the sender's number in each row, so a rerun task never changes the meaning of
a bitmap.

A group of copies that holds a third of all rows costs one entry per sender in
the exchange and one partial row per map task in the grouping.

Defined cases: null text is empty text, and all empty texts are one group. The
row with the largest ``doc_id`` stays; a null ``doc_id`` is smaller than any.
Rows that repeat both id and text are each reported as kept, and ``deduplicate``
returns one of them. An empty table gives an empty result. Other columns,
whatever their names, do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownlake.llm.common import prepare, shuffle_partitions, stored, texts

FINGERPRINT_BITS = 48
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CODED = "sender int, owner int, n int, shift int, quotients binary, remainders binary, repeated binary, ids array<bigint>, digests binary"
BITMAP = "sender int, owner int, marked binary"
ROWS = "doc_id bigint, digest binary, suspect boolean"


def golomb_encode(values: np.ndarray, span: int) -> tuple[int, bytes, bytes]:
    """Code sorted distinct integers below ``span``: (shift, unary quotients, fixed-width remainders) of their gaps."""
    gaps = np.diff(values, prepend=0).astype(np.uint64)
    shift = max(0, int(span // max(1, len(values))).bit_length() - 1)
    quotients = (gaps >> np.uint64(shift)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + len(values), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    widths = np.arange(shift - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> widths) & np.uint64(1)).astype(np.uint8)
    return shift, np.packbits(unary).tobytes(), np.packbits(rest.ravel()).tobytes()


def golomb_decode(n: int, shift: int, quotients: bytes, remainders: bytes) -> np.ndarray:
    """The integers that ``golomb_encode`` coded."""
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(quotients, np.uint8)) == 0)[:n]
    high = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(remainders, np.uint8))[: n * shift].reshape(n, shift).astype(np.uint64)
    low = (bits << np.arange(shift - 1, -1, -1, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum((high.astype(np.uint64) << np.uint64(shift)) | low).astype(np.int64)


def _send(owners: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    span = -(-(1 << FINGERPRINT_BITS) // owners)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, ids = [], []
        for batch in batches:
            ids.append(batch.column(0))
            for value in pc.ascii_lower(batch.column(1)):
                digests.append(hashlib.sha256(value.as_buffer()).digest())
        if not digests:
            return
        all_ids = pa.concat_arrays(ids)
        shas = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
        prints = np.zeros(len(shas), np.int64)
        for byte in range(FINGERPRINT_BITS // 8):
            prints = (prints << 8) | shas[:, byte]
        order = np.argsort(prints, kind="stable")
        prints, shas = prints[order], shas[order]
        all_ids = all_ids.take(pa.array(order))
        sender, owner = TaskContext.get().partitionId(), prints // span
        edges = np.flatnonzero(np.diff(owner, prepend=-1))
        for start, stop in zip(edges, [*edges[1:], len(prints)]):
            own = int(owner[start])
            distinct, counts = np.unique(prints[start:stop] - own * span, return_counts=True)
            shift, high, low = golomb_encode(distinct, span)
            yield pa.RecordBatch.from_pydict(
                {
                    "sender": pa.array([sender], pa.int32()),
                    "owner": pa.array([own], pa.int32()),
                    "n": pa.array([len(distinct)], pa.int32()),
                    "shift": pa.array([shift], pa.int32()),
                    "quotients": pa.array([high], pa.binary()),
                    "remainders": pa.array([low], pa.binary()),
                    "repeated": pa.array([np.packbits(counts > 1).tobytes()], pa.binary()),
                    "ids": pa.array([all_ids.slice(start, stop - start).to_pylist()], pa.list_(pa.int64())),
                    "digests": pa.array([shas[start:stop].tobytes()], pa.binary()),
                }
            )

    return run


def _own(lists: pd.DataFrame) -> pd.DataFrame:
    """One owner: mark the fingerprints that two senders have, or one sender has twice."""
    decoded = [golomb_decode(r.n, r["shift"], r.quotients, r.remainders) for _, r in lists.iterrows()]
    repeated = [np.unpackbits(np.frombuffer(r, np.uint8))[: len(d)].astype(bool) for r, d in zip(lists["repeated"], decoded)]
    values, counts = np.unique(np.concatenate(decoded), return_counts=True)
    shared = np.union1d(values[counts > 1], np.concatenate([d[r] for d, r in zip(decoded, repeated)]))
    marks = [np.packbits(np.isin(d, shared)).tobytes() for d in decoded]
    return pd.DataFrame({"sender": lists["sender"], "owner": lists["owner"], "marked": marks})


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each list, marked by the sender's bitmap."""
    for batch in batches:
        for r in batch.to_pylist():
            shas = np.frombuffer(r["digests"], np.uint8).reshape(-1, 32)
            which = np.cumsum((np.diff(shas[:, : FINGERPRINT_BITS // 8].astype(np.int16), axis=0) != 0).any(axis=1)) if len(shas) > 1 else []
            which = np.concatenate([[0], which]).astype(np.int64)
            marked = np.unpackbits(np.frombuffer(r["marked"], np.uint8))[which].astype(bool)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(r["ids"], pa.int64()),
                    "digest": pa.array([x.tobytes() for x in shas], pa.binary()),
                    "suspect": pa.array(marked),
                }
            )


def normalised(text) -> F.Column:
    """Text with A-Z, and nothing else, in lower case; null reads as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """One stored row per document: ``doc_id``, SHA-256 of the normalised text, ``suspect`` by the exchange."""
    spark = docs.sparkSession
    prepare(spark)
    owners = shuffle_partitions(spark)
    coded = stored(texts(docs).mapInArrow(_send(owners), CODED), "fingerprints")
    marks = (
        coded.select("sender", "owner", "n", "shift", "quotients", "remainders", "repeated")
        .groupBy("owner")
        .applyInPandas(_own, BITMAP)
    )
    answered = coded.select("sender", "owner", "ids", "digests").join(marks, ["sender", "owner"])
    return stored(answered.select("ids", "digests", "marked").mapInArrow(_resolve, ROWS), "suspects")


def _suspect_ids(rows: DataFrame) -> DataFrame:
    return rows.where("suspect").select(F.col("doc_id").alias("__suspect_id")).distinct()


def decisions(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    rows = fingerprint_rows(docs)
    suspects = _suspect_ids(rows)
    plain = texts(docs)
    groups = (
        plain.join(suspects, F.col("doc_id").eqNullSafe(F.col("__suspect_id")), "left_semi")
        .groupBy(normalised(F.col("text")).alias("__text"))
        .agg(F.max("doc_id").alias("__keep"), F.count(F.lit(1)).alias("__size"))
        .select(F.unhex(F.sha2("__text", 256)).alias("__digest"), "__keep", "__size")
    )
    return rows.join(groups, F.col("digest") == F.col("__digest"), "left").select(
        "doc_id",
        F.when(F.col("__size").isNull(), F.col("doc_id")).otherwise(F.col("__keep")).alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("__size").isNull(), F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("__keep"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns; texts keep their letters' case.

    Other columns may have any name and type. Of rows with equal ids and texts the last by its JSON form stays.
    """
    suspects = _suspect_ids(fingerprint_rows(docs))
    rows = docs.select(F.struct(*docs.columns).alias("__row"))
    is_suspect = F.col("__row.doc_id").eqNullSafe(F.col("__suspect_id"))
    alone = rows.join(suspects, is_suspect, "left_anti")
    last = F.struct(F.col("__row.doc_id").alias("doc_id"), F.to_json("__row").alias("row"))
    winners = (
        rows.join(suspects, is_suspect, "left_semi")
        .groupBy(normalised(F.col("__row.text")).alias("__text"))
        .agg(F.max_by("__row", last).alias("__row"))
        .select("__row")
    )
    return alone.unionByName(winners).select(*[F.col("__row")[c].alias(c) for c in docs.columns])
