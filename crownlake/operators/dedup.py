"""Deterministic, skew-safe keyed deduplication.

``dropDuplicates`` keeps an arbitrary survivor, and ``row_number()`` over a
window sends every row of a key to one task. Here the survivor is chosen by an
aggregate — ``min``/``max`` over a struct whose leading fields are the
ordering columns and whose remaining fields are all other columns — so:

* the choice is a total order (ties broken by the full row), hence repeatable;
* the aggregate runs partial-then-final, so a key holding a third of all rows
  is first reduced inside every map task and never gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownlake.session import path_bytes, scratch_path

_PACKED = "_survivor"


def _survivor(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    keys, order = list(keys), [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    reduced = df.groupBy(*keys).agg(pick(packed).alias(_PACKED))
    return reduced.select(*keys, *[F.col(_PACKED)[c].alias(c) for c in order + rest]).select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the row that is smallest by ``order``, then by all columns."""
    return _survivor(df, keys, order, F.min)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: the row that is largest by ``order``, then by all columns."""
    return _survivor(df, keys, order, F.max)


# Stored keys up to this size are broadcast by Spark's default threshold.
BROADCAST_KEYS = 10 * 1024 * 1024


def keep_first_stored(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``keep_first`` of stored rows: where few keys repeat, only the rows of these are shuffled and sorted.

    Keys are first counted by a 64-bit hash, without the wide rows. A row whose hash is alone is its key's only
    one. The others are reduced and stored; if so many hashes repeat that they can't be broadcast, all rows are.
    """
    mark = F.xxhash64(*keys)
    twice = rows.groupBy(mark.alias("_mark")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_mark")
    repeated, repeated_bytes = _stored_keys(twice, "repeated")
    if repeated.isEmpty():
        return rows
    if repeated_bytes > BROADCAST_KEYS:
        return _stored_keys(keep_first(rows, keys, order), "firsts")[0]
    marked, repeated = rows.withColumn("_mark", mark), F.broadcast(repeated)
    firsts, _ = _stored_keys(keep_first(marked.join(repeated, "_mark", "left_semi").drop("_mark"), keys, order), "firsts")
    return marked.join(repeated, "_mark", "left_anti").drop("_mark").unionByName(firsts)


def _stored_keys(keys: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Keys or rows written under the shared folder and read back, and their bytes there."""
    path = scratch_path(keys.sparkSession, name)
    keys.write.parquet(path)
    return keys.sparkSession.read.schema(keys.schema).parquet(path), path_bytes(keys.sparkSession, path)


def drop_seen(new: DataFrame, existing: DataFrame, keys: Sequence[str], within: str | None = None) -> DataFrame:
    """Rows of ``new`` whose ``keys`` are not in ``existing`` (an incremental merge); NULL keys equal each other.

    ``new`` is one landing (small); ``existing`` is the whole table (large). A
    plain anti-join would shuffle every existing key on each run. Instead the
    existing keys are first semi-joined with the keys of ``new`` — the small
    side is the build side, so Catalyst/AQE can broadcast it when its measured
    size allows, and the large side is then only scanned and filtered — and
    ``new`` is anti-joined with that (at most ``new``-sized) result.

    ``within``: a column of both that rows with equal keys share, such as the
    event time. Only the range of it that ``new`` covers is then compared, which
    costs a pass over ``new``: pass stored rows. The seen keys are then stored too, so
    their size is known before the wide rows of ``new`` are joined: without any,
    ``new`` is returned as it is; if they are many, the unseen keys are joined
    instead. The smaller of both is broadcast where Catalyst can, and ``new`` not shuffled.
    """
    if within is not None:
        # As text, so that no driver-side type conversion or time zone is involved.
        least, most = new.agg(F.min(within).cast("string"), F.max(within).cast("string")).first()
        kind = existing.schema[within].dataType
        covered = F.col(within).between(F.lit(least).cast(kind), F.lit(most).cast(kind))
        existing = existing.where(covered | F.col(within).isNull())
    other = {k: f"_seen_{k}" for k in keys}
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(o)) for k, o in other.items()])
    theirs = [F.col(k).alias(o) for k, o in other.items()]
    already = existing.select(*keys).join(new.select(*theirs).distinct(), same, "left_semi").select(*theirs)
    if within is None:
        return new.join(already, same, "left_anti")
    seen, seen_bytes = _stored_keys(already, "seen")
    if seen.isEmpty():
        return new
    if seen_bytes <= BROADCAST_KEYS:
        return new.join(seen, same, "left_anti")
    unseen, _ = _stored_keys(new.select(*theirs).distinct().join(seen.withColumnsRenamed({o: k for k, o in other.items()}), same, "left_anti"), "unseen")
    return new.join(unseen, same, "left_semi")
