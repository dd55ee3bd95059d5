"""Incremental ingestion with Structured Streaming.

R1 — new landed raw files trigger the silver jobs of battles and of profiles.
``ingest`` is a file-source stream (explicit schema, ``_metadata`` for landing
tag/day) with ``trigger(availableNow=True)``: each run processes every file
landed since the last checkpoint, then stops — the scheduled-batch cadence with
exactly-once file tracking. Each micro-batch is merged into silver by
``foreachBatch``: normalise, build silver rows and store them, keep one row per key
(deterministic, ``keep_first_stored``: only rows of repeated keys are shuffled), drop
keys already in silver (``drop_seen``), append. A replayed epoch (after a failure between the write and the checkpoint
commit) finds its keys already present and appends nothing, so the sink is
idempotent. Battle items set aside go to ``rejects_path`` with their reason, one
folder per epoch, which a replay overwrites.

Land each pull under a new file name: the file source tracks *paths*, so a
file rewritten in place is not read again.

R2 — overlapping logs: the same merge deduplicates. Its memory is silver itself,
so a battle is recognised however late a repeat arrives, and history that lands
after newer days is kept. ``streaming.dedup`` keeps recent battles as state under a
watermark instead, and merges only what comes later than that.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crownlake.operators.bronze import normalize_battles, normalize_profiles
from crownlake.operators.dedup import drop_seen
from crownlake.operators.silver import first_stored_battles, first_stored_profiles, silver_battle_rows, silver_profile_rows
from crownlake.session import scratch_path
from crownlake.sources import raw as R
from crownlake.sources.sinks import FEW_DAYS, write_parquet


@dataclass(frozen=True)
class Feed:
    """One kind of landed payload.

    ``build`` gives a batch's rows before any deduplication and what it sets aside, if anything; ``first`` the silver
    rows of such rows once they are stored, one for each of ``keys``.
    """

    name: str
    schema: T.StructType
    build: Callable[[DataFrame], tuple[DataFrame, DataFrame | None]]
    first: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    within: str


def _battle_rows(batch: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    kept, rejects = normalize_battles(batch)
    return silver_battle_rows(kept), rejects


def _profile_rows(batch: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """A profile that lacks a required field fails the batch, as in the batch job."""
    return silver_profile_rows(normalize_profiles(batch)), None


BATTLES = Feed("battles", R.RAW_BATTLE_LANDED, _battle_rows, first_stored_battles, ("battle_id",), "battle_time")
PROFILES = Feed("profiles", R.RAW_PROFILE_LANDED, _profile_rows, first_stored_profiles, ("player_tag", "snapshot_at"), "snapshot_at")


def raw_stream(spark: SparkSession, path: str, feed: Feed = BATTLES, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(feed.schema)
              .option("recursiveFileLookup", "true").option("pathGlobFilter", R.LANDED_FILES))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return R.landing_columns(reader.json(path), feed.schema)


def _staged(df: DataFrame, name: str) -> DataFrame:
    """One micro-batch's rows, written once: the merge reads them more than once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merge_batch(batch: DataFrame, feed: Feed, silver_path: str, lake=None, rejects_path: str | None = None,
                epoch: int = 0) -> None:
    """Merge one micro-batch of raw items into the silver table, and into the gold tables of ``lake`` if one is given.

    With a lake the steps are those of an incremental pipeline run
    (``silver_to_gold``): partials and fact of the touched days, gold, then
    silver. A batch without a new row writes nothing. A lake without partials
    only gets the silver append (the first full pipeline run computes them).
    """
    rows, rejects = feed.build(batch)
    if rejects is not None and rejects_path is not None:
        rejects.write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/epoch={epoch}")
    append_unseen(rows, feed, silver_path, lake)


def append_unseen(rows: DataFrame, feed: Feed, silver_path: str, lake=None) -> None:
    """Append the first of the ``rows`` of each key that silver does not hold; with a lake that has partials, update gold first."""
    from crownlake.plans.pipeline import path_exists, silver_to_gold

    spark = rows.sparkSession
    # A deck's hash follows from the deck; ``first`` adds it.
    staged = _staged(rows.drop("deck_hash"), f"batch-{feed.name}")
    fresh = first = feed.first(staged)
    if path_exists(spark, silver_path):
        stored = spark.read.schema(first.schema).parquet(silver_path)
        fresh = drop_seen(first, stored, feed.keys, within=feed.within)
    if lake is not None and path_exists(spark, lake.partial("deck")):
        silver_to_gold(spark, lake, {feed.name: _staged(fresh, f"fresh-{feed.name}")})
    else:
        few = staged.select("ingestion_date").distinct().limit(FEW_DAYS + 1).count() <= FEW_DAYS
        write_parquet(fresh, silver_path, ["ingestion_date"], "append", few_days=few)


def ingest(
    spark: SparkSession,
    raw_path: str,
    silver_path: str,
    checkpoint_path: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    lake=None,
    feed: Feed = BATTLES,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Start the raw -> silver stream of one feed (R1). Returns the running query.

    With ``lake`` (a ``plans.pipeline.Lake``) each micro-batch also merges into
    the lake's gold tables (``merge_batch``)."""
    stream = raw_stream(spark, raw_path, feed, max_files_per_trigger)

    def sink(df: DataFrame, epoch: int) -> None:
        merge_batch(df, feed, silver_path, lake, rejects_path, epoch)

    writer = stream.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(sink)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_available_now(spark: SparkSession, raw_path: str, silver_path: str, checkpoint_path: str,
                      lake=None, feed: Feed = BATTLES, rejects_path: str | None = None) -> None:
    """One scheduled run: process everything landed since the last run, then stop."""
    q = ingest(spark, raw_path, silver_path, checkpoint_path, lake=lake, feed=feed, rejects_path=rejects_path)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
