"""Bronze -> silver: typing, ids, null filtering and keyed deduplication.

Differences from a literal re-run of the original jobs, all on purpose:

* times are parsed with the offset (``X``) and bad text becomes NULL instead
  of failing the job under ANSI mode (``try_`` casts everywhere);
* ``ingestion_date`` / ``snapshot_at`` come from each record's provenance
  (landing day, landing time), so re-reading the whole history does not stamp
  every row with the run date; pass ``run_date`` / ``run_ts`` for the literal
  behaviour;
* the dedup survivor is deterministic: earliest landing first, then landing
  order, then the full row (see ``operators.dedup``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownlake.functions import columns as X
from crownlake.operators.dedup import keep_first, keep_first_stored
from crownlake.schemas import SILVER_BATTLE_COLUMNS, SILVER_PROFILE_COLUMNS


def _provenance(bronze: DataFrame, name: str, dtype: str) -> F.Column:
    if name in bronze.columns:
        return F.col(name).cast(dtype)
    return F.lit(None).cast(dtype)


def silver_battle_rows(bronze: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """C3 without the dedup: typed rows with ids, nulls dropped (row-local, stream-safe).

    Keeps the landing order column ``_source_seq`` for the dedup step.
    """
    ingestion = F.lit(run_date).cast("date") if run_date else _provenance(bronze, "ingestion_date", "date")
    typed = bronze.select(
        F.col("player_tag"),
        X.parse_api_time("battle_time").alias("battle_time"),
        F.col("battle_type"),
        F.col("result"),
        F.col("player_trophies").try_cast("bigint").alias("player_trophies"),
        F.col("player_deck"),
        F.col("player_elixir_avg").try_cast("float").alias("player_elixir_avg"),
        F.col("crowns_player").try_cast("int").alias("crowns_player"),
        F.col("crowns_opponent").try_cast("int").alias("crowns_opponent"),
        F.col("opponent_tag"),
        F.col("opponent_deck"),
        ingestion.alias("ingestion_date"),
        _provenance(bronze, "source_seq", "bigint").alias("_source_seq"),
    )
    keyed = typed.select(
        "*",
        X.battle_id("player_tag", "battle_time").alias("battle_id"),
        X.deck_hash("player_deck").alias("deck_hash"),
    ).dropna(subset=["player_tag", "battle_time", "result"])
    return keyed


def silver_battles(bronze: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """Bronze battle records -> ``battles_silver`` (key ``battle_id``)."""
    keyed = silver_battle_rows(bronze, run_date)
    return first_battles(keyed)


def first_battles(rows: DataFrame) -> DataFrame:
    """One row per battle: its first landing. The deck's hash follows from the deck, so it is not shuffled with it."""
    return _battles_of(keep_first(rows.drop("deck_hash"), ["battle_id"], ["ingestion_date", "_source_seq"]))


def first_stored_battles(rows: DataFrame) -> DataFrame:
    """As ``first_battles``, of stored rows: a battle's row that no other shares is not shuffled.

    The id follows from other columns, as the deck's hash does: it need not be stored."""
    if "battle_id" not in rows.columns:
        rows = rows.withColumn("battle_id", X.battle_id("player_tag", "battle_time"))
    return _battles_of(keep_first_stored(rows.drop("deck_hash"), ["battle_id"], ["ingestion_date", "_source_seq"]))


def _battles_of(deduped: DataFrame) -> DataFrame:
    return deduped.withColumn("deck_hash", X.deck_hash("player_deck")).select(*SILVER_BATTLE_COLUMNS)


def silver_profiles(
    bronze: DataFrame,
    run_ts: dt.datetime | None = None,
    run_date: dt.date | None = None,
) -> DataFrame:
    """C4: bronze profiles -> ``profile_silver`` (key ``player_tag, snapshot_at``)."""
    deduped = keep_first(silver_profile_rows(bronze, run_ts, run_date), ["player_tag", "snapshot_at"], ["ingestion_date", "_source_seq"])
    return deduped.select(*SILVER_PROFILE_COLUMNS)


def first_stored_profiles(rows: DataFrame) -> DataFrame:
    """One row per profile snapshot of stored rows: its first landing."""
    return keep_first_stored(rows, ["player_tag", "snapshot_at"], ["ingestion_date", "_source_seq"]).select(*SILVER_PROFILE_COLUMNS)


def silver_profile_rows(
    bronze: DataFrame,
    run_ts: dt.datetime | None = None,
    run_date: dt.date | None = None,
) -> DataFrame:
    """C4 without the dedup: typed rows, those without a tag or name dropped (row-local)."""
    ingestion = F.lit(run_date).cast("date") if run_date else _provenance(bronze, "ingestion_date", "date")
    # Landing time, else the landing day: one snapshot per pull, not per run.
    landed = F.coalesce(_provenance(bronze, "ingested_at", "timestamp_ntz"),
                        _provenance(bronze, "ingestion_date", "date").cast("timestamp_ntz"))
    snapshot = F.lit(run_ts).cast("timestamp_ntz") if run_ts else landed
    typed = bronze.select(
        F.col("tag").alias("player_tag"),
        F.col("name").alias("player_name"),
        F.col("level").try_cast("int").alias("level"),
        F.col("trophies").try_cast("int").alias("trophies"),
        F.col("best_trophies").try_cast("int").alias("best_trophies"),
        F.col("wins").try_cast("int").alias("wins"),
        F.col("losses").try_cast("int").alias("losses"),
        F.col("battle_count").try_cast("int").alias("battle_count"),
        F.col("clan_name"),
        F.col("clan_tag"),
        snapshot.alias("snapshot_at"),
        ingestion.alias("ingestion_date"),
        _provenance(bronze, "source_seq", "bigint").alias("_source_seq"),
    )
    rated = typed.withColumn("win_rate", X.guarded_pct("wins", "battle_count"))
    return rated.dropna(subset=["player_tag", "player_name"])
