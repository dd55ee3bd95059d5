"""Vector codes from product codebooks, by Lloyd rounds over two trees.

Components become integers, floor(4096 x), and vectors are cut into eight
consecutive parts. For each part position a codebook of 16 entries starts as
the parts of the vectors with the smallest ids; every round assigns each part to its
nearest entry (the lower index on ties) and moves the entries to the floor of
their parts' mean. All arithmetic is on integers, so results do not depend on
how rows are dealt.

Each Arrow batch of vectors becomes one row of a stored table: for each part
position a balanced tree over the batch's parts, with a box and the sum of
components of every node. The codebook of a part position is a tree too. A round
walks both trees at once:

- a pair of nodes whose boxes are further apart than the farthest that another
  entry node can be from any of these parts is pruned; where single entries are left, one is
  dropped if another is nearer all over the part node's box;
- a part node with one entry left is assigned whole, by its cached sum;
- the parts of leaves with several entries left are compared one by one.

A task adds up its rows' trees and sends one sum per (part, entry, component);
the driver gets the sums of 8 x 16 entries. The final walk gives each vector's code and
error. Errors are summed per label with a map-side combine and joined back: broadcast
if there are few labels (counted first), else by label and a salt, so that no label is one task's work.

Defined cases: vectors that are null or empty, that hold a null, NaN or infinite
component, or whose length differs from that of the vector with the smallest id are left out, and
so is a component too large for sums of squares in 64 bits (``component_limit``: 16,384 at 64 dimensions).
Null ids come last; vectors that share an id are ordered by their components. With fewer than 16 vectors
the codebooks have that many entries. A length that eight does not divide gives
parts that differ by one component. Null labels are one group. Other columns are left
behind. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownlake.llm.common import prepare, stored
from crownlake.session import scratch_path

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
LEAF = 32  # parts of one leaf, at most
FEW_LABELS = 100_000  # with more labels their sums are joined by a shuffle
SALTS = 64
ROW_GROUP = 16 * 1024 * 1024
TREES = "n int, perm binary, points binary, low binary, high binary, sums binary"


def borders(dim: int) -> list[int]:
    return [p * dim // PARTS for p in range(PARTS + 1)]


def component_limit(dim: int) -> float:
    """Components from here on up do not fit: distances of ``dim`` squared differences must stay within 62 bits."""
    return 2.0 ** ((61 - math.ceil(math.log2(max(dim, 1)))) // 2 - 1) / SCALE


def integers(values: np.ndarray, dim: int) -> np.ndarray:
    """floor(4096 x) as (part, row, component), parts filled up with zeros to one width."""
    whole = np.floor(values.astype(np.float64).reshape(-1, dim) * SCALE).astype(np.int64)
    edge = borders(dim)
    width = max(b - a for a, b in zip(edge, edge[1:]))
    out = np.zeros((PARTS, len(whole), width), np.int64)
    for p in range(PARTS):
        out[p, :, : edge[p + 1] - edge[p]] = whole[:, edge[p] : edge[p + 1]]
    return out


def node_ranges(n: int, height: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one member of each node, root first; node i's children are 2i + 1 and 2i + 2."""
    level = [(np.arange((1 << h) + 1) * n) >> h for h in range(height + 1)]
    return np.concatenate([x[:-1] for x in level]), np.concatenate([x[1:] for x in level])


def tree_height(n: int, leaf: int) -> int:
    return max(0, math.ceil(math.log2(n / leaf))) if n else 0


class Tree:
    """Balanced trees over each part position: ``points`` (part, member, component) in tree order, ``perm`` to the rows."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        parts, n, width = points.shape
        height = tree_height(n, leaf)
        self.perm = np.tile(np.arange(n), (parts, 1))
        for p in range(parts):
            for h in range(height):
                edge = (np.arange((1 << h) + 1) * n) >> h
                half = (np.arange((1 << (h + 1)) + 1) * n) >> (h + 1)
                for i in range(1 << h):
                    own = self.perm[p, edge[i] : edge[i + 1]]
                    members = points[p, own]
                    axis = int(np.argmax(members.max(axis=0) - members.min(axis=0)))
                    own[:] = own[np.argpartition(members[:, axis], half[2 * i + 1] - edge[i])]
        self.points = np.take_along_axis(points, self.perm[:, :, None], axis=1)
        first = (np.arange(1 << height) * n) >> height
        low, high, sums = (
            [f.reduceat(self.points, first, axis=1)] for f in (np.minimum, np.maximum, np.add)
        )  # leaves, then each level above them
        for _ in range(height):
            low.insert(0, np.minimum(low[0][:, ::2], low[0][:, 1::2]))
            high.insert(0, np.maximum(high[0][:, ::2], high[0][:, 1::2]))
            sums.insert(0, sums[0][:, ::2] + sums[0][:, 1::2])
        self.low, self.high, self.sums = (np.concatenate(x, axis=1) for x in (low, high, sums))
        self.first, self.end = node_ranges(n, height)

    def packed(self) -> dict[str, object]:
        """One stored row; numbers below 2^31 take four bytes."""
        small = int(np.abs(self.points).max(initial=0)) < 1 << 31
        kind = np.int32 if small else np.int64
        return {
            "n": self.points.shape[1],
            "perm": self.perm.astype(np.uint32).tobytes(),
            "points": self.points.astype(kind).tobytes(),
            "low": self.low.astype(kind).tobytes(),
            "high": self.high.astype(kind).tobytes(),
            "sums": self.sums.tobytes(),
        }

    @classmethod
    def unpacked(cls, row: dict[str, object], width: int) -> Tree:
        tree = cls.__new__(cls)
        n = row["n"]
        kind = np.int32 if len(row["points"]) == 4 * PARTS * n * width else np.int64
        tree.perm = np.frombuffer(row["perm"], np.uint32).reshape(PARTS, n)
        tree.points = np.frombuffer(row["points"], kind).astype(np.int64).reshape(PARTS, n, width)
        tree.low, tree.high = (np.frombuffer(row[c], kind).astype(np.int64).reshape(PARTS, -1, width) for c in ("low", "high"))
        tree.sums = np.frombuffer(row["sums"], np.int64).reshape(PARTS, -1, width)
        tree.first, tree.end = node_ranges(n, tree_height(n, LEAF))
        return tree


class Book:
    """Codebooks (part, entry, component) with a tree over each; slots past the last entry repeat it and lose every tie."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.size = entries.shape[1]
        self.slots = 1 << max(self.size - 1, 0).bit_length()
        full = entries[:, np.minimum(np.arange(self.slots), self.size - 1)]
        self.tree = Tree(full, leaf=1)
        self.full = full


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def assign(tree: Tree, book: Book) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Walk both trees: entry of each part in tree order (part, member), and (part, entry) sums and counts."""
    parts, n, width = tree.points.shape
    nodes, e_nodes, slots = tree.low.shape[1], book.tree.low.shape[1], book.slots
    low, high = tree.low.reshape(-1, width), tree.high.reshape(-1, width)
    e_low, e_high = book.tree.low.reshape(-1, width), book.tree.high.reshape(-1, width)
    full, e_perm = book.full.reshape(-1, width), book.tree.perm
    spread, e_spread = _squares(high - low), _squares(e_high - e_low)
    last_inner = nodes // 2  # heap positions below this one have children
    codes = np.zeros((parts, n), np.int64)
    sums, counts = np.zeros((parts * slots, width), np.int64), np.zeros(parts * slots, np.int64)
    unsure = np.zeros((parts * nodes, slots), bool)

    def slot_of(e: np.ndarray) -> np.ndarray:
        part, at = np.divmod(e, e_nodes)
        return e_perm[part, np.maximum(at - (slots - 1), 0)]

    p, e = np.arange(parts) * nodes, np.arange(parts) * e_nodes
    while len(p):
        near = np.maximum(np.maximum(low[p] - e_high[e], e_low[e] - high[p]), 0)
        far = np.maximum(high[p] - e_low[e], e_high[e] - low[p])
        upper = _squares(far)
        best = np.full(parts * nodes, np.iinfo(np.int64).max)
        np.minimum.at(best, p, upper)
        keep = _squares(near) <= best[p]
        p, e, upper = p[keep], e[keep], upper[keep]
        single = e % e_nodes >= slots - 1
        mixed = np.zeros(parts * nodes, bool)
        mixed[p[~single]] = True
        # Where only entries are left, the most promising one may be nearer than another all over the box.
        plain = ~mixed[p]
        order = np.argsort(-upper, kind="stable")
        lead = np.zeros(parts * nodes, np.int64)
        lead[p[order]] = slot_of(e)[order]
        own, part = slot_of(e), p // nodes
        a, b = full[part * slots + lead[p]], full[part * slots + own]
        gap = b - a
        excess = np.einsum("ij,ij->i", 2 * np.where(gap > 0, high[p], low[p]), gap) + _squares(a) - _squares(b)
        beaten = plain & (lead[p] != own) & ((excess < 0) | ((excess == 0) & (lead[p] < own)))
        p, e, own, plain = p[~beaten], e[~beaten], own[~beaten], plain[~beaten]
        left = np.bincount(p, minlength=parts * nodes)
        whole = plain & (left[p] == 1)
        if whole.any():
            part, at = np.divmod(p[whole], nodes)
            target = part * slots + own[whole]
            np.add.at(sums, target, tree.sums[part, at])
            np.add.at(counts, target, tree.end[at] - tree.first[at])
            for q, i, s in zip(part.tolist(), at.tolist(), own[whole].tolist()):
                codes[q, tree.first[i] : tree.end[i]] = s
        leaf = p % nodes >= last_inner
        open_ = plain & ~whole & leaf
        unsure[p[open_], own[open_]] = True
        go = ~whole & ~open_
        p, e, leaf = p[go], e[go], leaf[go]
        # Of a part node and its entry nodes the wider ones split.
        inner = e % e_nodes < slots - 1
        split_e = inner & (leaf | (e_spread[e] >= spread[p]))
        waits = np.zeros(parts * nodes, bool)
        waits[p[split_e]] = True
        split_p = ~waits[p]
        part, at = np.divmod(e[split_e], e_nodes)
        e_child = part * e_nodes + 2 * at + 1
        q_part, q_at = np.divmod(p[split_p], nodes)
        p_child = q_part * nodes + 2 * q_at + 1
        rest = waits[p] & ~split_e
        p, e = (
            np.concatenate([p[rest], p[split_e], p[split_e], p_child, p_child + 1]),
            np.concatenate([e[rest], e_child, e_child + 1, e[split_p], e[split_p]]),
        )
    leaves = np.flatnonzero(unsure.any(axis=1))
    if len(leaves):
        part, at = np.divmod(leaves, nodes)
        size = tree.end[at] - tree.first[at]
        which = np.repeat(np.arange(len(leaves)), size)
        member = tree.first[at][which] + np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        part = part[which]
        values = tree.points[part, member]
        nearest, code = np.full(len(values), np.iinfo(np.int64).max), np.zeros(len(values), np.int64)
        for s in range(slots):
            asked = np.flatnonzero(unsure[leaves, s][which])
            distance = _squares(values[asked] - full[part[asked] * slots + s])
            better = distance < nearest[asked]
            nearest[asked[better]] = distance[better]
            code[asked[better]] = s
        codes[part, member] = code
        target = part * slots + code
        order = np.argsort(target, kind="stable")
        first = np.flatnonzero(np.diff(target[order], prepend=-1))
        sums[target[order][first]] += np.add.reduceat(values[order], first, axis=0)
        counts += np.bincount(target, minlength=len(counts))
    shape = (parts, slots, width)
    return np.minimum(codes, book.size - 1), sums.reshape(shape)[:, : book.size], counts.reshape(parts, slots)[:, : book.size]


def _plant(dim: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each batch of vectors as one row: its ids and labels as lists, and its trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            tree = Tree(integers(batch.column("vector").flatten().to_numpy(zero_copy_only=False), dim)).packed()
            lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(c)) for c in ("id", "label")]
            kinds = [pa.int32()] + [pa.binary()] * 5
            yield pa.RecordBatch.from_arrays(lists + [pa.array([v], k) for v, k in zip(tree.values(), kinds)], names=names)

    return run


def _sum_up(entries: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row per (part, entry) of this task: components' sums and the number of parts."""
    _, size, width = entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Book(entries)
        sums, counts = np.zeros(entries.shape, np.int64), np.zeros(entries.shape[:2], np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                _, s, c = assign(Tree.unpacked(row, width), book)
                sums, counts = sums + s, counts + c
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part * size + entry, pa.int32()),
                pa.array(counts[part, entry], pa.int64()),
                pa.array(sums[part, entry].tolist(), pa.list_(pa.int64())),
            ],
            names=["entry", "n", "sums"],
        )

    return run


def _encode(entries: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    width = entries.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Book(entries)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("n", "perm", "points", "low", "high", "sums")}
                tree = Tree.unpacked(row, width)
                codes, _, _ = assign(tree, book)
                rest = tree.points - np.take_along_axis(entries, codes[:, :, None], axis=1)
                in_rows = np.empty_like(codes)
                error = np.zeros(row["n"], np.int64)
                for p in range(PARTS):
                    in_rows[p, tree.perm[p]] = codes[p]
                    error[tree.perm[p]] += _squares(rest[p])
                digits = in_rows.T.astype(np.uint8).tobytes().hex()
                text = [digits[at : at + 2 * PARTS] for at in range(0, len(digits), 2 * PARTS)]
                ids, labels = (batch.column(c)[i].values for c in ("ids", "labels"))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text, pa.string()), pa.array(error)], names=["id", "label", "code", "error"])

    return run


def finite(vector: Column) -> Column:
    """Whether a vector is not null, not empty and holds neither nulls nor NaN nor infinities."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def fit(trees: DataFrame, entries: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks after ``rounds`` of Lloyd's algorithm over the stored trees."""
    shape = entries.shape
    for _ in range(rounds):
        partial = trees.select(*[c.split()[0] for c in TREES.split(", ")]).mapInArrow(_sum_up(entries), "entry int, n bigint, sums array<bigint>")
        per_value = partial.select("entry", "n", F.posexplode("sums").alias("place", "value"))
        # Sums of sums are decimals, which cannot overflow.
        rows = per_value.groupBy("entry", "place").agg(
            F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.sum(F.col("n").cast("decimal(38,0)")).alias("n")
        )
        entries = entries.copy().reshape(-1, shape[2])
        for r in rows.collect():  # 8 x 16 entries of one part's width
            entries[r["entry"], r["place"]] = int(r["total"]) // int(r["n"])
        entries = entries.reshape(shape)
    return entries


def codebook_text(entries: np.ndarray, dim: int) -> str:
    """All components by part, entry and place, joined by commas."""
    edge = borders(dim)
    return ",".join(str(x) for p in range(PARTS) for row in entries[p] for x in row[: edge[p + 1] - edge[p]].tolist())


def compress(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray | None, int]:
    """(``id, label, code, error`` of every kept vector, the final codebooks (part, entry, component), the dimension)."""
    spark = vectors.sparkSession
    prepare(spark)
    vector = F.col("vector")
    plain = vectors.select(
        F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("vector")
    ).where(finite(vector))
    kind = {f.name: f.dataType.simpleString() for f in plain.schema}
    order = [F.col("id").asc_nulls_last(), vector]
    ahead = plain.select("id", "vector").orderBy(*order).limit(1).collect()
    if not ahead:
        empty = spark.createDataFrame([], f"id {kind['id']}, label {kind['label']}, code string, error bigint")
        return empty, None, 0
    dim = len(ahead[0]["vector"])
    limit = F.lit(component_limit(dim))
    plain = plain.where((F.size(vector) == dim) & ~F.exists(vector, lambda x: F.abs(x) >= limit))
    head = plain.select("id", "vector").orderBy(*order).limit(ENTRIES).collect()
    if not head:
        return compress(vectors.limit(0), id_column, vector_column, label_column, rounds)
    entries = integers(np.array([r["vector"] for r in head]).reshape(-1), dim)
    names = ["ids", "labels"] + [c.split()[0] for c in TREES.split(", ")]
    schema = f"ids array<{kind['id']}>, labels array<{kind['label']}>, {TREES}"
    path = scratch_path(spark, "vector-trees")
    plain.mapInArrow(_plant(dim, names), schema).write.option("parquet.block.size", ROW_GROUP).parquet(path)
    trees = spark.read.schema(schema).parquet(path)
    entries = fit(trees, entries, rounds)
    return trees.mapInArrow(_encode(entries), f"id {kind['id']}, label {kind['label']}, code string, error bigint"), entries, dim


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the sum of ``error`` over all rows of the same label."""
    totals = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    if totals.count() <= FEW_LABELS:
        totals = F.broadcast(totals.withColumnRenamed("label", "of"))
        return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).drop("of")
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)))
    copies = totals.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"))
    same = F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt"))
    return salted.join(copies, same).drop("of", "of_salt", "salt")


def code_report(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept vector."""
    coded, entries, dim = compress(vectors)
    digest = hashlib.sha256(codebook_text(entries, dim).encode()).hexdigest() if entries is not None else ""
    coded = stored(coded, "vector-codes")
    return with_label_error(coded).select(
        F.col("id").cast("long").alias("vec_id"), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
