"""N-gram Jaccard join: groups of documents linked by word n-gram sets with a Jaccard of at least ``percent`` / 100.

Documents with equal sets form a class, and only classes are compared.

1. Every text's distinct n-gram hashes give its set size, a digest and a profile
   of 64 hash ranges; a fixed table of hashed n-gram counts over all documents
   orders n-grams rare-first.
2. Each class posts the n-grams of its prefix in that order: two sets that link
   share one there. N-grams with one class drop out.
3. Postings of one n-gram with the same set size and position are a cell. Cells
   are paired under the length and the positional filter, so a frequent n-gram
   that can't be the first common one of any linked pair costs a few cells, not
   pairs of documents.
4. In a pair of cells, each class meets the other cell's first class only. What
   the suffix filter (difference of the profiles) leaves is verified once per
   pair on whole sets: of each class first the pair with the smallest class,
   then those that these links have not united yet.
5. Only classes of one pair of cells that are still in different components are
   paired, filtered and verified as well. No link between components is lost.

Hashes have 64 bits. Classes are told apart by a 64-bit key of a 128-bit digest;
two digests with one key stop the job.

Defined cases: a null or empty text, or one without words, has an empty set and
links with nothing. A text with fewer words than ``n`` is one n-gram of all of
them. Rows with a null ``doc_id`` count as the smallest id. Repeated rows are
one class. Rows that share an id are told apart by their class. An empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownlake.llm.common import lean, possibly_in, prepare, stored, texts, utf8_bytes
from crownlake.llm.components import components, joined

RANGES = 64
COUNT_SLOTS, COUNT_SLICES = 1 << 18, 16
FAN_IN = 64
SLICE_BYTES = 1 << 20
# Different sets with one class key are named by the rest of their digest, up to this many keys.
MOST_CLASHES = 10_000
NULL_KEY = -(1 << 63)

SETS = "doc_id bigint, class bigint, digest binary, n_shingles bigint, profile array<smallint>"
POSTINGS = "gram bigint, place int, size int, class bigint"
HASHES = "class bigint, grams binary"

# Fixed random weights of bytes, and odd multipliers, of the word and n-gram hashes.
_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = _RNG.integers(1, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _INVERSE = int(_ODD[15]), pow(int(_ODD[15]), -1, 1 << 64)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[13]
    x = (x ^ (x >> np.uint64(29))) * _ODD[14]
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_up, _down = _powers(_BASE, SLICE_BYTES + 1), _powers(_INVERSE, SLICE_BYTES + 1)


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each word (run without white space) of some bytes, in order; in slices that end at white space."""
    global _up, _down
    out, at = [], 0
    while at < len(data):
        stop = min(len(data), at + SLICE_BYTES)
        if stop < len(data):
            gaps = np.flatnonzero(_WHITE[data[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
            else:
                later = np.flatnonzero(_WHITE[data[stop:]])
                stop = stop + int(later[0]) + 1 if len(later) else len(data)
        part = data[at:stop]
        if len(part) >= len(_up):
            _up, _down = _powers(_BASE, len(part) + 1), _powers(_INVERSE, len(part) + 1)
        solid = ~_WHITE[part]
        edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * _up[: len(part)], dtype=np.uint64)])
        out.append(mixed((sums[ends] - sums[starts]) * _down[starts] + (ends - starts).astype(np.uint64)))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of consecutive words, or of the whole sequence if it is shorter."""
    if not len(words):
        return np.zeros(0, np.uint64)
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, np.uint64(width))
    for j in range(width):
        total = (total + words[j : len(words) - width + 1 + j]) * _ODD[j % 13]
        total ^= total >> np.uint64(31)
    return np.unique(mixed(total))


def _sets_of(batch: pa.Array, n: int) -> Iterator[np.ndarray]:
    data, offsets = utf8_bytes(pc.ascii_lower(batch))
    for i in range(len(batch)):
        yield gram_hashes(word_hashes(data[offsets[i] : offsets[i + 1]]), n)


def digest_of(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


@dataclass(frozen=True)
class Keys:
    """Class keys of sets: the first ``bits`` of a digest, but for digests that share them with another: ``renamed``."""

    bits: int = 64
    renamed: dict[bytes, int] = field(default_factory=dict)

    def of(self, digest: bytes) -> int:
        known = self.renamed.get(digest)
        return int.from_bytes(digest[:8], "little", signed=True) >> (64 - self.bits) if known is None else known


def _describe(n: int, keys: Keys) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, profiles = [], [], []
            for grams in _sets_of(batch.column("text"), n):
                digests.append(digest_of(grams))
                sizes.append(len(grams))
                profiles.append(np.minimum(np.bincount((grams >> np.uint64(58)).astype(np.int64), minlength=RANGES), 32767).astype(np.int16))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "class": pa.array([keys.of(d) for d in digests], pa.int64()),
                    "digest": pa.array(digests, pa.binary()),
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "profile": pa.array(profiles, pa.list_(pa.int16())),
                }
            )

    return run


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(COUNT_SLOTS - 1)).astype(np.int64)


def _count(n: int) -> Callable:
    """A task's documents per hashed n-gram, in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNT_SLOTS, np.int64)
        for batch in batches:
            if sets := list(_sets_of(batch.column("text"), n)):
                counts += np.bincount(_slot(np.concatenate(sets)), minlength=COUNT_SLOTS)
        if counts.any():
            parts = np.split(counts, COUNT_SLICES)
            yield pa.RecordBatch.from_pydict(
                {
                    "slice": pa.array(range(COUNT_SLICES), pa.int32()),
                    "sender": pa.array([TaskContext.get().partitionId()] * COUNT_SLICES, pa.int32()),
                    "counts": pa.array([p.tobytes() for p in parts], pa.binary()),
                }
            )

    return run


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.int64) for c in rows["counts"])
    return pd.DataFrame({"slice": rows["slice"][:1], "sender": rows["sender"][:1] // FAN_IN, "counts": [total.tobytes()]})


def gram_counts(docs: DataFrame, n: int) -> np.ndarray:
    """Documents per hashed n-gram over all of ``docs``: a table of fixed size, merged by at most FAN_IN senders at a time."""
    schema = "slice int, sender int, counts binary"
    counts, senders = docs.select("text").mapInArrow(lean(_count(n)), schema), docs.rdd.getNumPartitions()
    while senders > 1:
        counts = counts.groupBy("slice", F.floor(F.col("sender") / FAN_IN)).applyInPandas(_merge, schema)
        senders = -(-senders // FAN_IN)
    out = np.zeros((COUNT_SLICES, COUNT_SLOTS // COUNT_SLICES), np.int64)
    for r in counts.collect():
        out[r["slice"]] += np.frombuffer(r["counts"], np.int64)
    return np.minimum(out.ravel(), (1 << 31) - 1).astype(np.int32)


def _post(n: int, percent: int, sent, keys: Keys) -> Callable:
    """Prefixes of the classes that a task meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = sent.value, set()
        for batch in batches:
            out: list[tuple[np.ndarray, int, int]] = []
            for grams in _sets_of(batch.column("text"), n):
                own = keys.of(digest_of(grams)) if len(grams) else None
                if own is None or own in seen:
                    continue
                seen.add(own)
                size = len(grams)
                length = size - -(-percent * size // 100) + 1
                first = np.lexsort((grams, counts[_slot(grams)]))[:length]
                out.append((grams[first], size, own))
            if out:
                lengths = np.array([len(g) for g, _, _ in out])
                yield pa.RecordBatch.from_pydict(
                    {
                        "gram": pa.array(np.concatenate([g for g, _, _ in out]).view(np.int64)),
                        "place": pa.array(np.concatenate([np.arange(x, dtype=np.int32) for x in lengths])),
                        "size": pa.array(np.repeat(np.array([s for _, s, _ in out], np.int32), lengths)),
                        "class": pa.array(np.repeat(np.array([c for _, _, c in out], np.int64), lengths)),
                    }
                )

    return run


def _whole(n: int, keys: Keys) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets_of(batch.column("text"), n))
            yield pa.RecordBatch.from_pydict(
                {"class": pa.array([keys.of(digest_of(g)) for g in sets], pa.int64()), "grams": pa.array([g.tobytes() for g in sets], pa.binary())}
            )

    return run


def _verify(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _overlap(percent: int, x: Column, y: Column) -> Column:
    """Least number of common n-grams of two sets that link, by their sizes."""
    return F.ceil((x + y) * percent / F.lit(100.0 + percent) - 1e-9)


class _Join:
    """The steps of one join; tables that two steps need are stored."""

    def __init__(self, docs: DataFrame, n: int, percent: int, key_bits: int = 64) -> None:
        self.plain, self.n, self.percent, self.keys = texts(docs), n, percent, Keys(key_bits)
        prepare(docs.sparkSession)
        self.sets = stored(self.plain.mapInArrow(lean(_describe(n, self.keys)), SETS), "ngram-sets")
        self.classes = self._classes()
        while clashes := [r["class"] for r in self.classes.where("clash").select("class").limit(MOST_CLASHES + 1).collect()]:
            self._rename(clashes)
            self.classes = self._classes()
        self.classes = self.classes.drop("clash")

    def _classes(self) -> DataFrame:
        least = F.min(F.coalesce("doc_id", F.lit(NULL_KEY)))
        clash = F.min("digest") != F.max("digest")
        classes = self.sets.where("n_shingles > 0").groupBy("class").agg(least.alias("first"), F.first("profile").alias("profile"), clash.alias("clash"))
        return stored(classes, "ngram-classes")

    def _rename(self, clashes: list[int]) -> None:
        """Of different sets with one class key, all but one get a key from the rest of their digest.

        Expected are n^2 / 2^65 such pairs among n sets: some seventy among 5 * 10^10.
        """
        if len(clashes) > MOST_CLASHES:
            raise ValueError(f"over {MOST_CLASHES} class keys stand for different sets")
        spark = self.plain.sparkSession
        asked = F.broadcast(spark.createDataFrame([(c,) for c in clashes], "class bigint"))
        twins: dict[int, list[bytes]] = {}
        for r in self.sets.where("n_shingles > 0").join(asked, "class", "left_semi").select("class", "digest").distinct().collect():
            twins.setdefault(r["class"], []).append(bytes(r["digest"]))
        fresh = {d: int.from_bytes(d[8:], "little", signed=True) for same in twins.values() for d in sorted(same)[1:]}
        self.keys = Keys(self.keys.bits, {**self.keys.renamed, **fresh})
        named = F.broadcast(spark.createDataFrame([(bytearray(d), k) for d, k in fresh.items()], "digest binary, __renamed bigint"))
        given = self.sets.join(named, "digest", "left").withColumn("class", F.coalesce("__renamed", "class")).select(*self.sets.columns)
        self.sets = stored(given, "ngram-sets")

    def postings(self) -> DataFrame:
        """Prefix n-grams that at least two classes have."""
        spark = self.plain.sparkSession
        sent = spark.sparkContext.broadcast(gram_counts(self.plain, self.n))
        posted = stored(self.plain.select("text").mapInArrow(lean(_post(self.n, self.percent, sent, self.keys)), POSTINGS), "ngram-postings", "zstd")
        shared = posted.groupBy("gram").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi").select("gram")
        return stored(posted.join(shared, "gram").distinct(), "ngram-shared")

    def cell_pairs(self, postings: DataFrame) -> DataFrame:
        """Pairs of cells (gram, size, place) under the length and the positional filter, in both directions."""
        cells = postings.groupBy("gram", "size", "place").agg(F.min("class").alias("first"), F.max("class").alias("last"))
        other = cells.select("gram", F.col("size").alias("size2"), F.col("place").alias("place2"), F.col("first").alias("first2"), F.col("last").alias("last2"))
        near = (F.col("size") * 100 >= F.col("size2") * self.percent) & (F.col("size2") * 100 >= F.col("size") * self.percent)
        bound = F.least(F.col("size") - F.col("place"), F.col("size2") - F.col("place2"))
        alone = (F.col("size") == F.col("size2")) & (F.col("place") == F.col("place2")) & (F.col("first") == F.col("last"))
        return cells.join(other, "gram").where(near & (bound >= _overlap(self.percent, F.col("size"), F.col("size2"))) & ~alone).drop("first", "last", "last2")

    def filtered(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a < b) that the suffix filter leaves."""
        a, b = F.least("class", "class2").alias("a"), F.greatest("class", "class2").alias("b")
        pairs = pairs.select(a, b, F.when(F.col("class") < F.col("class2"), F.col("size")).otherwise(F.col("size2")).alias("na"), (F.col("size") + F.col("size2")).alias("n"))
        pairs = pairs.where("a < b").distinct()
        for side in ("a", "b"):
            profile = self.classes.select(F.col("class").alias(side), F.col("profile").alias(f"p{side}"))
            pairs = pairs.join(profile, side)
        differ = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.abs(x.cast("int") - y.cast("int"))), F.lit(0), lambda s, x: s + x)
        return pairs.where(differ <= F.col("n") - 2 * _overlap(self.percent, F.col("n"), F.lit(0))).select("a", "b")

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs whose whole sets link."""
        pairs = stored(pairs, f"ngram-{name}")
        if pairs.isEmpty():
            return pairs
        needed = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
        firsts = stored(needed.join(self.classes, "class").select(F.col("first").alias("__id")).distinct(), f"ngram-{name}-ids")
        key = F.coalesce(F.col("doc_id"), F.lit(NULL_KEY))
        few = possibly_in(self.plain.withColumn("doc_id", key), firsts, "__id").join(firsts, F.col("doc_id") == F.col("__id"), "left_semi")
        whole = few.select("text").mapInArrow(_whole(self.n, self.keys), HASHES).join(needed, "class", "left_semi").dropDuplicates(["class"])
        whole = stored(whole, f"ngram-{name}-sets")
        both = pairs
        for side, grams in (("a", "x"), ("b", "y")):
            both = both.join(whole.select(F.col("class").alias(side), F.col("grams").alias(grams)), side)
        return stored(both.select("a", "b", "x", "y").mapInArrow(_verify(self.percent), "a bigint, b bigint"), f"ngram-{name}-links")

    def apart(self, pairs: DataFrame, known: DataFrame) -> DataFrame:
        """The pairs whose classes are in different components of those ``known``."""
        for side in ("a", "b"):
            label = known.select(F.col("vertex").alias(side), F.col("label").alias(f"l{side}"))
            pairs = pairs.join(label, side, "left").withColumn(f"l{side}", F.coalesce(f"l{side}", side))
        return pairs.where("la <> lb").select("a", "b")

    def labels(self) -> DataFrame:
        """``class, label`` of every class that links with another one."""
        postings = self.postings()
        cells = stored(self.cell_pairs(postings), "ngram-cells")
        star = postings.join(cells, ["gram", "size", "place"]).select("class", "size", F.col("first2").alias("class2"), "size2")
        tried = stored(self.filtered(star), "ngram-stars")
        smallest = stored(tried.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "ngram-smallest")
        known = stored(components(self.verified(smallest, "star")), "ngram-known")
        known = joined(known, self.verified(self.apart(tried.join(smallest, ["a", "b"], "left_anti"), known), "stars"))
        labelled = postings.join(known.withColumnRenamed("vertex", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
        # Pairs of cells whose classes are not all in one component yet.
        spread = labelled.groupBy("gram", "size", "place").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        other = spread.select("gram", F.col("size").alias("size2"), F.col("place").alias("place2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
        open_ = (
            cells.where(F.struct("size", "place") <= F.struct("size2", "place2"))
            .join(spread, ["gram", "size", "place"])
            .join(other, ["gram", "size2", "place2"])
            .where(~((F.col("lo") == F.col("hi")) & (F.col("lo2") == F.col("hi2")) & (F.col("lo") == F.col("lo2"))))
            .select("gram", "size", "place", "size2", "place2")
        )
        left = labelled.join(open_, ["gram", "size", "place"])
        right = labelled.select("gram", F.col("size").alias("size2"), F.col("place").alias("place2"), F.col("class").alias("class2"), F.col("label").alias("label2"))
        rest = left.join(right, ["gram", "size2", "place2"]).where("label <> label2").select("class", "size", "class2", "size2")
        more = self.verified(self.filtered(rest).join(tried, ["a", "b"], "left_anti"), "rest")
        return joined(known, more)


def _named(join: _Join) -> DataFrame:
    """``class, first, label`` of every class; classes of one component have one label."""
    named = join.classes.join(join.labels().withColumnRenamed("vertex", "class"), "class", "left")
    return named.select("class", "first", F.coalesce("label", "class").alias("label"))


def linked_groups(docs: DataFrame, n: int = 5, percent: int = 80, key_bits: int = 64) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id`` of every row: smallest ids of its component, and of the rows with its set."""
    join = _Join(docs, n, percent, key_bits)
    named = _named(join)
    least = named.groupBy("label").agg(F.min("first").alias("component"))
    ids = named.select("class", "label", F.col("first").alias("class_first")).join(least, "label").drop("label")
    rows = join.sets.select("doc_id", "n_shingles", "class").join(ids, "class", "left")

    def or_own(c: str) -> Column:
        return F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.nullif(F.col(c), F.lit(NULL_KEY)))

    return rows.select("doc_id", "n_shingles", or_own("component").alias("component_id"), or_own("class_first").alias("class_id"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, key_bits: int = 64) -> DataFrame:
    """Rows of ``docs``, all columns: one of each linked group, and all that have no words.

    The one has the group's smallest id; of several classes with that id the smallest, and of its rows with it the first by text.
    Other columns may have any name and type.
    """
    join = _Join(docs, n, percent, key_bits)
    kept = _named(join).groupBy("label").agg(F.min(F.struct("first", "class")).alias("kept")).select("kept.class", "kept.first")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY))
    rows = join.sets.groupBy(key.alias("__key"), "class").agg(F.count(F.lit(1)).alias("rows"), F.max("n_shingles").alias("size"))
    stay = F.when(F.col("size") == 0, F.col("rows")).when(F.col("first") == F.col("__key"), 1).otherwise(0)
    decided = stored(rows.join(kept, "class", "left").select("__key", "class", "rows", stay.alias("stay")), "ngram-decided")
    ids = decided.groupBy("__key").agg(F.sum("rows").alias("rows"), F.sum("stay").alias("stay")).where("stay < rows")
    ids = stored(ids.select("__key", (F.col("stay") > 0).alias("some")), "ngram-gone")
    whole = docs.select(F.struct(*docs.columns).alias("__row"), key.alias("__key"))
    staying = whole.join(ids.select("__key"), "__key", "left_anti").select("__row")
    some = ids.where("some").select("__key")
    if not some.isEmpty():
        staying = staying.unionByName(_some_rows(whole, decided.join(some, "__key", "left_semi"), join))
    return staying.select(*[F.col("__row")[c].alias(c) for c in docs.columns])


def _some_rows(whole: DataFrame, decided: DataFrame, join: _Join) -> DataFrame:
    """Of the ids in ``decided``, of which some rows go and some stay: the rows (``__row``) that stay."""
    n, keys = join.n, join.keys

    @F.arrow_udf("long")
    def class_key(batch: pa.Array) -> pa.Array:
        return pa.array([keys.of(digest_of(g)) for g in _sets_of(batch, n)], pa.int64())

    rows = whole.join(decided.select("__key").distinct(), "__key", "left_semi")
    rows = rows.withColumn("__class", class_key(F.coalesce(F.col("__row.text"), F.lit(""))))
    staying = decided.where("stay > 0").select("__key", F.col("class").alias("__class"), (F.col("stay") == F.col("rows")).alias("__all"))
    met = stored(rows.join(staying, ["__key", "__class"]), "ngram-some")
    first = F.min_by("__row", F.struct(F.col("__row.text").alias("text"), F.to_json("__row").alias("row")))
    one = met.where("NOT __all").groupBy("__key", "__class").agg(first.alias("__row"))
    return met.where("__all").select("__row").unionByName(one.select("__row"))
