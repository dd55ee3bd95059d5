"""Streaming deduplication under a watermark, without losing late rows (R2).

Each day's log repeats earlier battles. Two lanes read the landing:

* the timely lane keeps the battles of the last ``delay`` (by battle time) as
  state: ``withWatermark`` and ``dropDuplicatesWithinWatermark`` drop every exact
  repeat before anything is written. State older than the watermark is evicted, so
  it is bounded by the battles of ``delay``, whatever the history. Different records of
  one battle pass, and the sink keeps the first of them by the same total order as the batch job;
* the late lane takes the rows that the timely lane's watermark has passed,
  which Spark drops there: it filters the same files on battle time and merges
  what silver does not hold yet.

Both sinks append only keys that silver lacks (``append_unseen``), so a
replayed epoch, or a row that both lanes see, changes nothing. The first
landing of a battle wins, as in the batch job.

The lanes share a landing but not a checkpoint. Should a run end between them,
the next run's late lane still has its files, and without a watermark of that
run it merges all of their rows.

State lives in ``spark.sql.shuffle.partitions`` stores, fixed by the first run; for state beyond the executors' heap set
``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crownlake.operators.bronze import normalize_battles
from crownlake.operators.silver import silver_battle_rows
from crownlake.schemas import SILVER_BATTLE_COLUMNS
from crownlake.streaming.ingest import BATTLES, append_unseen, raw_stream

EVENT, COPY = "_event", "_copy"


@dataclass(frozen=True)
class DedupRun:
    """What one run did: rows read, kept state rows, rows behind the watermark, and that watermark."""

    rows_in: int
    state_rows: int
    late_rows: int
    watermark: dt.datetime | None


def battle_rows(raw: DataFrame) -> DataFrame:
    """Silver rows of raw items, before any deduplication; row-local, so it also runs on a stream."""
    kept, _ = normalize_battles(raw)
    return silver_battle_rows(kept)


def without_repeats(rows: DataFrame, delay: str) -> DataFrame:
    """Exact repeats of a battle record within ``delay`` dropped, by state."""
    marked = rows.withColumns({
        EVENT: F.col("battle_time").cast("timestamp"),
        COPY: F.xxhash64(*[F.col(c) for c in SILVER_BATTLE_COLUMNS if c != "ingestion_date"]),
    })
    # The deck's hash counts for the copy, but follows from the deck: it is not shuffled.
    marked = marked.drop("deck_hash")
    return marked.withWatermark(EVENT, delay).dropDuplicatesWithinWatermark(["battle_id", COPY]).drop(EVENT, COPY)


def _merge(rows: DataFrame, silver_path: str, lake) -> None:
    append_unseen(rows, BATTLES, silver_path, lake)


def _finished(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def run_deduplicated(spark: SparkSession, raw_path: str, silver_path: str, checkpoint_path: str, delay: str = "30 days",
                     max_files_per_trigger: int | None = None, lake=None) -> DedupRun:
    """One scheduled run of both lanes over what has landed since the last one."""

    def lane(name: str, rows: DataFrame) -> StreamingQuery:
        return _finished(rows.writeStream.option("checkpointLocation", f"{checkpoint_path.rstrip('/')}/{name}")
                         .foreachBatch(lambda df, _: _merge(df, silver_path, lake)).trigger(availableNow=True).start())

    rows = battle_rows(raw_stream(spark, raw_path, BATTLES, max_files_per_trigger))
    progress = [p for p in lane("timely", without_repeats(rows, delay)).recentProgress if "watermark" in (p.eventTime or {})]
    states = [p.stateOperators[0] for p in progress if p.stateOperators]
    # Rows are dropped against the watermark that a batch starts with; it never falls, so the last one covers all.
    watermark = max((dt.datetime.fromisoformat(p.eventTime["watermark"]) for p in progress if p.numInputRows), default=None)
    late = F.lit(True) if watermark is None else F.col("battle_time").cast("timestamp") < F.lit(watermark)
    lane("late", rows.where(late))
    return DedupRun(
        rows_in=sum(p.numInputRows for p in progress),
        state_rows=states[-1].numRowsTotal if states else 0,
        late_rows=sum(s.numRowsDroppedByWatermark for s in states),
        watermark=watermark,
    )
