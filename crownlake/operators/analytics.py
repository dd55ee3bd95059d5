"""Saved analytics and dashboard queries (C13-C25) as DataFrame functions.

All parameters of the original queries (battle types, thresholds, k) are
arguments with the original values as defaults. Every top-k carries the group
key as the last sort key so ties at the k-th row resolve the same way in any
engine; null order is always written out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownlake.functions import columns as X
from crownlake.operators.streaks import DEFAULT_UNITS, streak_summary


def top_k(df: DataFrame, order: Sequence[Column], k: int | None) -> DataFrame:
    """``ORDER BY ... LIMIT k`` (planned as TakeOrderedAndProject: per-partition top-k, then merge)."""
    ordered = df.orderBy(*order)
    return ordered if k is None else ordered.limit(k)


def _with_types(df: DataFrame, types: Sequence[str] | None) -> DataFrame:
    return df.where(F.col("battle_type").isin(*types)) if types is not None else df


# --- C13 -------------------------------------------------------------------

def deck_leaderboard(
    fact: DataFrame,
    types: Sequence[str] | None = X.LEADERBOARD_BATTLE_TYPES,
    min_battles: int = 5,
    k: int | None = 20,
) -> DataFrame:
    """Win rate per deck over the given battle types, from ``min_battles``, top k."""
    g = _with_types(fact, types).groupBy("deck_hash").agg(
        F.count(F.lit(1)).alias("total_battles"),
        X.count_if(X.is_win()).alias("wins"),
        F.round(F.avg("player_elixir_avg"), 2).alias("avg_elixir"),
    )
    g = g.where(F.col("total_battles") >= min_battles).withColumn(
        "win_rate_pct", X.pct("wins", "total_battles"))
    out = g.select("deck_hash", "total_battles", "wins", "win_rate_pct", "avg_elixir")
    return top_k(out, [F.col("win_rate_pct").desc_nulls_last(), F.col("deck_hash").asc_nulls_last()], k)


# --- card statistics (C14, C20, C21) ------------------------------------------

def card_battle_stats(battles: DataFrame, unique_battles: bool = True, distinct_cards: bool = False) -> DataFrame:
    """Per card: distinct battles holding it and wins counted per listing.

    The original counts ``COUNT(DISTINCT battle_id)`` over the unnested deck and
    sums wins over every listing (a card listed twice counts twice in wins).
    When ``battle_id`` is unique in the input — silver guarantees it — the
    distinct count equals a plain count over the *distinct* cards of each deck,
    and the win sum equals the card's multiplicity in winning decks. That plan
    has no distinct aggregation: one partial/final aggregate keyed by card.

    ``distinct_cards=True`` counts a card once per battle in wins too, so a
    rate never passes 100 %.
    """
    if not unique_battles:
        deck = F.array_distinct("player_deck") if distinct_cards else F.col("player_deck")
        exploded = battles.select("battle_id", "result", F.explode(deck).alias("card_name"))
        return exploded.groupBy("card_name").agg(
            F.countDistinct("battle_id").alias("battles_with_card"),
            X.count_if(X.is_win()).alias("wins_with_card"),
        )
    per_card = battles.select(
        "result", "player_deck", F.explode(F.array_distinct("player_deck")).alias("card_name"))
    listed = F.lit(1) if distinct_cards else X.multiplicity("player_deck", "card_name")
    win_listings = F.when(X.is_win(), listed).otherwise(F.lit(0))
    return per_card.groupBy("card_name").agg(
        F.count(F.lit(1)).alias("battles_with_card"),
        F.sum(win_listings).cast("bigint").alias("wins_with_card"),
    )


def card_leaderboard(
    battles: DataFrame,
    types: Sequence[str] | None = X.LEADERBOARD_BATTLE_TYPES,
    min_battles: int = 5,
    k: int | None = 15,
    order_by: str = "win_rate_pct",
    unique_battles: bool = True,
    distinct_cards: bool = False,
) -> DataFrame:
    """C14 (and C21 with other arguments): card win rate, from ``min_battles``, top k."""
    stats = card_battle_stats(_with_types(battles, types), unique_battles, distinct_cards)
    kept = stats.where(F.col("battles_with_card") >= min_battles).withColumn(
        "win_rate_pct", X.pct("wins_with_card", "battles_with_card"))
    out = kept.select("card_name", "battles_with_card", "wins_with_card", "win_rate_pct")
    return top_k(out, [F.col(order_by).desc_nulls_last(), F.col("card_name").asc_nulls_last()], k)


def card_win_rate_all(battles: DataFrame, min_battles: int = 3, k: int | None = 10,
                      unique_battles: bool = True) -> DataFrame:
    """All battle types, from 3 battles, top 10 by use."""
    return card_leaderboard(battles, None, min_battles, k, "battles_with_card", unique_battles)


def top_cards(battles: DataFrame, k: int | None = 10, unique_battles: bool = True) -> DataFrame:
    """C20: cards by number of distinct battles that list them, top k."""
    if unique_battles:
        names = battles.select(F.explode(F.array_distinct("player_deck")).alias("card_name"))
        used = names.groupBy("card_name").agg(F.count(F.lit(1)).alias("times_used"))
    else:
        names = battles.select("battle_id", F.explode("player_deck").alias("card_name"))
        used = names.groupBy("card_name").agg(F.countDistinct("battle_id").alias("times_used"))
    return top_k(used, [F.col("times_used").desc_nulls_last(), F.col("card_name").asc_nulls_last()], k)


# --- C15, C24 ----------------------------------------------------------------

def streak_leaderboard(fact: DataFrame, k: int | None = 20, units: Sequence[str] = DEFAULT_UNITS) -> DataFrame:
    """Longest streak and number of streaks per player and result, top k."""
    return top_streaks(streak_summary(fact, units=units), k)


def top_streaks(summary: DataFrame, k: int | None = 20) -> DataFrame:
    """C15 from streaks per player and result, computed or stored."""
    out = summary.select("player_tag", "streak_type", "longest_streak", "num_streaks")
    return top_k(out, [F.col("longest_streak").desc_nulls_last(), F.col("player_tag").asc_nulls_last(),
                       F.col("streak_type").asc_nulls_last()], k)


def longest_streaks(fact: DataFrame, units: Sequence[str] = DEFAULT_UNITS) -> DataFrame:
    """Longest streak per result over all players."""
    return longest_of(streak_summary(fact, units=units))


def longest_of(summary: DataFrame) -> DataFrame:
    """C24 from streaks per player and result, computed or stored."""
    out = summary.groupBy("streak_type").agg(F.max("longest_streak").alias("longest_streak"))
    return out.orderBy(F.col("longest_streak").desc_nulls_last(), F.col("streak_type").asc_nulls_last())


# --- C16, C23 ----------------------------------------------------------------

def elixir_by_outcome(
    battles: DataFrame,
    battle_type: str | None = X.PVP_BATTLE_TYPE,
    labels: tuple[str, str] = X.OUTCOME_LABELS_SAVED,
    with_stddev: bool = True,
) -> DataFrame:
    """Elixir by result, labelled win vs the rest.

    Grouped by ``result`` as the original is, so loss and draw give two rows
    with the same label; ``result`` is kept in the output to tell them apart.
    """
    src = battles.where(F.col("battle_type") == battle_type) if battle_type else battles
    aggs = [F.count(F.lit(1)).alias("total_battles"), F.round(F.avg("player_elixir_avg"), 3).alias("avg_elixir")]
    if with_stddev:
        aggs.append(F.round(F.stddev_samp("player_elixir_avg"), 3).alias("stddev_elixir"))
    g = src.groupBy("result").agg(*aggs)
    cols = [X.outcome_label("result", labels).alias("outcome"), "result", "total_battles", "avg_elixir"]
    if with_stddev:
        cols.append("stddev_elixir")
    return g.orderBy(F.col("result").desc_nulls_last()).select(*cols)


def elixir_by_outcome_simple(battles: DataFrame) -> DataFrame:
    """Dashboard variant, no stddev, dashboard labels."""
    return elixir_by_outcome(battles, labels=X.OUTCOME_LABELS_DASHBOARD, with_stddev=False)


# --- C17, C18, C19, C25 (profiles) -------------------------------------------

def trophies_by_date(profiles: DataFrame, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """C17: players, average and maximum trophies per ingestion date, newest first.

    ``approx=True`` counts players with ``approx_count_distinct`` (HyperLogLog++,
    relative standard deviation ``rsd``): one partial/final aggregate with
    fixed-size sketches instead of the (date, player) pre-aggregation an exact
    distinct needs.
    """
    players = F.approx_count_distinct("player_tag", rsd) if approx else F.countDistinct("player_tag")
    g = profiles.groupBy("ingestion_date").agg(
        players.alias("unique_players"),
        F.round(F.avg("trophies"), 0).alias("avg_trophies"),
        F.round(F.max("trophies"), 0).alias("max_trophies"),
    )
    return g.orderBy(F.col("ingestion_date").desc_nulls_last())


def trophies_by_date_asc(profiles: DataFrame) -> DataFrame:
    """Average and maximum trophies per ingestion date, oldest first."""
    g = profiles.groupBy("ingestion_date").agg(
        F.round(F.avg("trophies"), 0).alias("avg_trophies"),
        F.max("trophies").alias("max_trophies"),
    )
    return g.orderBy(F.col("ingestion_date").asc_nulls_last())


LATEST_PROFILE_COLUMNS = [
    "player_tag", "player_name", "level", "trophies", "best_trophies", "wins", "losses",
    "battle_count", "clan_name", "win_rate", "ingestion_date",
]


def latest_profile(profiles: DataFrame) -> DataFrame:
    """The newest snapshot (by ingestion date, then snapshot time).

    The newest date is a scalar subquery on the partition column, so of a stored
    table only the newest partition's files are read.
    """
    newest = profiles.agg(F.max("ingestion_date")).scalar()
    profiles = profiles.where(F.col("ingestion_date").eqNullSafe(newest))
    order = [F.col("ingestion_date").desc_nulls_last(), F.col("snapshot_at").desc_nulls_last(),
             F.col("player_tag").asc_nulls_last()]
    return profiles.orderBy(*order).limit(1).select(*LATEST_PROFILE_COLUMNS)


def outcome_split(profiles: DataFrame) -> DataFrame:
    """Wins, losses, draws = max(0, total - wins - losses) and win % per snapshot.

    ``wins``/``losses`` fall back to 0 and the total to 1 when missing or 0.
    """
    wins = X.falsy_default("wins", 0)
    losses = X.falsy_default("losses", 0)
    total = X.falsy_default("battle_count", 1)
    return profiles.select(
        "player_tag",
        "snapshot_at",
        wins.alias("wins"),
        losses.alias("losses"),
        X.clamp_at_zero(total - wins - losses).alias("draws"),
        total.alias("total_battles"),
        X.pct(wins, total, 1).alias("win_pct"),
    )


# --- C22 ---------------------------------------------------------------------

def deck_with_cards(
    fact: DataFrame,
    battles: DataFrame,
    literal: bool = True,
    min_battles: int = 3,
    k: int | None = 5,
) -> DataFrame:
    """Deck win rate with its card list, top k.

    The saved query joins ``fact`` to ``silver`` on ``deck_hash`` — many to many,
    so a deck with n battles becomes n*n rows and ``total_battles``/``wins`` are
    inflated (``literal=True`` reproduces exactly that). Either way the plan
    aggregates each side to one row per deck first (eager aggregation) and then
    joins one row to one row: ``total = n_f*n_s``, ``wins = w_f*n_s``; the
    average elixir over the fan-out equals the fact side's average. No fan-out
    is ever materialised. ``literal=False`` gives the repaired counts.
    """
    f = fact.groupBy("deck_hash").agg(
        F.count(F.lit(1)).alias("n_f"),
        X.count_if(X.is_win()).alias("w_f"),
        F.avg("player_elixir_avg").alias("e_f"),
    )
    s = battles.groupBy("deck_hash").agg(
        F.count(F.lit(1)).alias("n_s"),
        F.max("player_deck").alias("deck_cards"),
    )
    j = f.join(s, "deck_hash", "inner")
    total = F.col("n_f") * F.col("n_s") if literal else F.col("n_f")
    wins = F.col("w_f") * F.col("n_s") if literal else F.col("w_f")
    out = j.select(
        "deck_hash",
        total.alias("total_battles"),
        wins.alias("wins"),
        X.pct(wins, total).alias("win_rate_pct"),
        F.round(F.col("e_f"), 2).alias("avg_elixir"),
        "deck_cards",
    ).where(F.col("total_battles") >= min_battles)
    return top_k(out, [F.col("win_rate_pct").desc_nulls_last(), F.col("deck_hash").asc_nulls_last()], k)
