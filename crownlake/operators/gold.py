"""Silver -> gold: dimensions, fact and per-player metric tables.

Every table is one aggregate (partial on the map side, final after one
shuffle) or a projection. Nothing here uses a per-key window: the latest
profile per player is a ``max`` over a struct led by ``snapshot_at``, which
reduces a hot player inside each map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crownlake.functions import columns as X
from crownlake.operators.dedup import keep_last
from crownlake.schemas import DIM_PLAYER_COLUMNS, FACT_BATTLE_COLUMNS


def dim_player(profiles: DataFrame) -> DataFrame:
    """The latest snapshot of each player.

    ``max`` over a struct led by ``snapshot_at``: partial and final, so a
    player with a huge history is reduced map-side.
    """
    latest = keep_last(profiles.select(*DIM_PLAYER_COLUMNS), ["player_tag"], ["snapshot_at"])
    return latest.select(*DIM_PLAYER_COLUMNS)


def dim_player_window(profiles: DataFrame) -> DataFrame:
    """C5 as the original states it: row number 1 by newest time.

    The filter on the row number becomes a group limit before the exchange, which keeps one row
    per player and map task, so a player with a huge history is not gathered. Null times come
    last, and equal times are settled by the other columns, as in ``dim_player``.
    """
    rest = [c for c in DIM_PLAYER_COLUMNS if c not in ("player_tag", "snapshot_at")]
    newest = Window.partitionBy("player_tag").orderBy(*[F.col(c).desc_nulls_last() for c in ["snapshot_at", *rest]])
    numbered = profiles.select(*DIM_PLAYER_COLUMNS, F.row_number().over(newest).alias("_place"))
    return numbered.where(F.col("_place") == 1).drop("_place")


def dim_card(battles: DataFrame) -> DataFrame:
    """Distinct card names over both decks (one scan, no union)."""
    both = F.concat(
        F.coalesce(F.col("player_deck"), F.array().cast("array<string>")),
        F.coalesce(F.col("opponent_deck"), F.array().cast("array<string>")),
    )
    names = battles.select(F.explode(both).alias("card_name"))
    return names.where(F.col("card_name").isNotNull()).distinct()


def dim_card_union(battles: DataFrame) -> DataFrame:
    """C6 as in the original: the cards of either deck, united by name (two scans)."""
    sides = [battles.select(F.explode(deck).alias("card_name")) for deck in ("player_deck", "opponent_deck")]
    return sides[0].unionByName(sides[1]).where(F.col("card_name").isNotNull()).distinct()


def deck_stats(battles: DataFrame, keys: list[str]) -> DataFrame:
    return battles.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_battles"),
        X.count_if(X.is_win()).alias("wins"),
    )


def dim_deck(battles: DataFrame, canonical: bool = False) -> DataFrame:
    """Decks with battles, wins, average elixir and win rate.

    Grouped by ``(deck_hash, player_deck)`` as in the original, so one hash may
    give several rows when card order differs; ``canonical=True`` groups by the
    sorted deck instead (one row per hash).
    """
    deck = F.sort_array("player_deck") if canonical else F.col("player_deck")
    grouped = battles.groupBy("deck_hash", deck.alias("player_deck")).agg(
        F.count(F.lit(1)).alias("total_battles"),
        X.count_if(X.is_win()).alias("wins"),
        F.round(F.avg("player_elixir_avg"), 2).alias("elixir_avg"),
    )
    return grouped.withColumn("win_rate", X.pct("wins", "total_battles"))


def fact_battles(battles: DataFrame) -> DataFrame:
    """The fact table (projection of silver)."""
    return battles.select(*FACT_BATTLE_COLUMNS)


def card_counts(battles: DataFrame) -> DataFrame:
    """Shared aggregate of C9 and C12: uses and wins per (player, card)."""
    exploded = battles.select("player_tag", "result", F.explode("player_deck").alias("card_name"))
    return exploded.groupBy("player_tag", "card_name").agg(
        F.count(F.lit(1)).alias("uses"),
        X.count_if(X.is_win()).alias("wins"),
    )


def win_rate_by_card(battles: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """``metrics_win_rate_by_card``."""
    c = counts if counts is not None else card_counts(battles)
    return c.select(
        "player_tag", "card_name", F.col("uses").alias("appearances"), "wins",
        X.pct("wins", "uses").alias("win_rate"),
    )


def card_usage(battles: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """``metrics_top_cards`` (usage per player; no sort, no limit)."""
    c = counts if counts is not None else card_counts(battles)
    return c.select(
        "player_tag", "card_name", F.col("uses").alias("usage_count"), "wins",
        X.pct("wins", "uses").alias("win_rate"),
    )


def win_rate_by_deck(battles: DataFrame, min_battles: int = 5) -> DataFrame:
    """Per player and deck, kept from ``min_battles`` battles."""
    stats = deck_stats(battles, ["player_tag", "deck_hash", "player_deck"])
    kept = stats.where(F.col("total_battles") >= min_battles)
    return kept.withColumn("win_rate", X.pct("wins", "total_battles"))


def trophy_evolution(battles: DataFrame, ordered: bool = False) -> DataFrame:
    """C11: weekly (Monday) maximum of starting trophies per player."""
    week = F.date_trunc("week", F.col("battle_time")).cast("timestamp_ntz")
    out = battles.groupBy("player_tag", week.alias("week")).agg(F.max("player_trophies").alias("trophies"))
    return out.orderBy("player_tag", "week") if ordered else out


def trophy_steps(evolution: DataFrame) -> DataFrame:
    """Each player's weeks numbered in order; ``steady``: no week before, or the same trophies as then.

    The window holds the weeks of one player, already aggregated: a bounded number.
    """
    weeks = Window.partitionBy("player_tag").orderBy("week")
    before = F.lag("trophies").over(weeks)
    return evolution.select("player_tag", "week", "trophies", F.row_number().over(weeks).alias("week_no"),
                            (before.isNull() | (before == F.col("trophies"))).alias("steady"))


GOLD_TABLE_NAMES = (
    "dim_player", "dim_card", "dim_deck", "fact_battles", "metrics_win_rate_by_card",
    "metrics_win_rate_by_deck", "metrics_trophy_evolution", "metrics_top_cards",
)


def gold_tables(battles: DataFrame, profiles: DataFrame) -> dict[str, DataFrame]:
    """All eight gold tables; C9 and C12 share one aggregate."""
    counts = card_counts(battles)
    return {
        "dim_player": dim_player(profiles),
        "dim_card": dim_card(battles),
        "dim_deck": dim_deck(battles),
        "fact_battles": fact_battles(battles),
        "metrics_win_rate_by_card": win_rate_by_card(battles, counts),
        "metrics_win_rate_by_deck": win_rate_by_deck(battles),
        "metrics_trophy_evolution": trophy_evolution(battles),
        "metrics_top_cards": card_usage(battles, counts),
    }
