"""Gold and analytics jobs on hand-written silver rows (golden values + rewrites)."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

from crownlake.functions import columns as X
from crownlake.operators import analytics as A
from crownlake.operators import gold as G
from crownlake.operators.coerce import coerce_result, stringify

BATTLES = ("player_tag string, battle_time timestamp_ntz, battle_type string, result string, "
           "player_trophies bigint, player_deck array<string>, player_elixir_avg float, crowns_player int, "
           "crowns_opponent int, opponent_tag string, opponent_deck array<string>, ingestion_date date, "
           "battle_id string, deck_hash string")
PROFILES = ("player_tag string, player_name string, level int, trophies int, best_trophies int, wins int, "
            "losses int, battle_count int, clan_name string, clan_tag string, win_rate double, "
            "snapshot_at timestamp_ntz, ingestion_date date")


def battles(spark, rows):
    """rows: (player, time, type, result, deck, elixir, trophies)."""
    out = []
    for i, (p, t, ty, r, deck, e, tr) in enumerate(rows):
        out.append((p, t, ty, r, tr, list(deck) if deck is not None else None, e, 1, 0, "O", ["X"],
                    t.date(), f"id{i}", None))
    df = spark.createDataFrame(out, BATTLES)
    return df.withColumn("deck_hash", X.deck_hash("player_deck"))


T0 = dt.datetime(2024, 1, 1, 12)


def test_card_listed_twice_rate_over_100(spark):
    df = battles(spark, [("P", T0, "PvP", "win", ["A", "A", "B"], 3.0, 1)] * 1)
    lit = {r.card_name: (r.battles_with_card, r.wins_with_card, r.win_rate_pct)
           for r in A.card_leaderboard(df, min_battles=1, unique_battles=False).collect()}
    x4 = {r.card_name: (r.battles_with_card, r.wins_with_card, r.win_rate_pct)
          for r in A.card_leaderboard(df, min_battles=1).collect()}
    assert lit["A"] == (1, 2, 200.0) == x4["A"]
    assert lit == x4
    for unique in (True, False):
        once = {r.card_name: r.win_rate_pct for r in
                A.card_leaderboard(df, min_battles=1, unique_battles=unique, distinct_cards=True).collect()}
        assert once == {"A": 100.0, "B": 100.0}


def random_battles(spark, seed, n=300):
    rng = random.Random(seed)
    cards = ["A", "B", "C", "D", None]
    rows = []
    for i in range(n):
        deck = [rng.choice(cards) for _ in range(rng.randrange(0, 5))] if rng.random() > 0.05 else None
        rows.append((f"P{rng.randrange(8)}", T0 + dt.timedelta(hours=i), rng.choice(["PvP", "Ladder", "x"]),
                     rng.choice(["win", "loss", "draw"]), deck, rng.choice([None, 1.0, 2.5, 3.25]),
                     rng.randrange(1000)))
    return battles(spark, rows)


def as_set(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_distinct_free_card_stats_equal_literal(spark):
    for seed in (1, 2):
        df = random_battles(spark, seed)
        assert as_set(A.card_battle_stats(df)) == as_set(A.card_battle_stats(df, unique_battles=False))
        assert as_set(A.top_cards(df, k=None)) == as_set(A.top_cards(df, k=None, unique_battles=False))


def test_eager_aggregation_counts_pairs_of_battles(spark):
    for seed in (3, 4):
        df = random_battles(spark, seed)
        rows = [r for r in df.collect() if r.deck_hash is not None]
        pairs = Counter((a.deck_hash, a.result == "win") for a in rows for b in rows if a.deck_hash == b.deck_hash)
        eager = A.deck_with_cards(G.fact_battles(df), df, literal=True, min_battles=1, k=None).collect()
        assert {r.deck_hash: (r.total_battles, r.wins) for r in eager} == {
            h: (pairs[h, True] + pairs[h, False], pairs[h, True]) for h in {r.deck_hash for r in rows}}


def test_repaired_deck_counts(spark):
    rows = [("P", T0 + dt.timedelta(hours=i), "PvP", r, ["A", "B"], 2.0, 1)
            for i, r in enumerate(["win", "win", "loss"])]
    df = battles(spark, rows)
    lit = A.deck_with_cards(G.fact_battles(df), df, literal=True).first()
    rep = A.deck_with_cards(G.fact_battles(df), df, literal=False).first()
    assert (lit.total_battles, lit.wins) == (9, 6)
    assert (rep.total_battles, rep.wins) == (3, 2)
    assert lit.win_rate_pct == rep.win_rate_pct == 66.67
    assert rep.deck_cards == ["A", "B"]


def test_topk_tie_break_on_group_key(spark):
    rows = []
    for deck in (["A"], ["B"], ["C"]):
        rows += [("P", T0 + dt.timedelta(hours=len(rows) + i), "PvP", "win", deck, 1.0, 1) for i in range(5)]
    df = battles(spark, rows)
    top = A.deck_leaderboard(df, k=2).collect()
    hashes = sorted(r.deck_hash for r in A.deck_leaderboard(df, k=None).collect())
    assert [r.deck_hash for r in top] == hashes[:2]


def test_deck_leaderboard_filters_types_and_threshold(spark):
    rows = [("P", T0 + dt.timedelta(hours=i), "challenge", "win", ["A"], 1.0, 1) for i in range(6)]
    rows += [("P", T0 + dt.timedelta(days=1, hours=i), "Ladder", "loss", ["B"], 1.0, 1) for i in range(4)]
    assert A.deck_leaderboard(battles(spark, rows)).count() == 0


def test_elixir_by_outcome_groups_by_result(spark):
    rows = [("P", T0 + dt.timedelta(hours=i), "PvP", r, ["A"], e, 1)
            for i, (r, e) in enumerate([("win", 2.0), ("win", 4.0), ("loss", 1.0), ("draw", 5.0)])]
    out = {r.result: r for r in A.elixir_by_outcome(battles(spark, rows)).collect()}
    assert (out["win"].outcome, out["loss"].outcome, out["draw"].outcome) == ("Winner", "Loser", "Loser")
    assert out["win"].avg_elixir == 3.0
    assert out["loss"].stddev_elixir is None  # one row
    simple = {r.result: r.outcome for r in A.elixir_by_outcome_simple(battles(spark, rows)).collect()}
    assert simple == {"win": "Vitória", "loss": "Derrota", "draw": "Derrota"}


def test_sunday_and_monday_are_different_weeks(spark):
    sunday, monday = dt.datetime(2024, 1, 7, 10), dt.datetime(2024, 1, 8, 10)
    df = battles(spark, [("P", sunday, "PvP", "win", ["A"], 1.0, 10), ("P", monday, "PvP", "win", ["A"], 1.0, 20)])
    weeks = sorted((r.week, r.trophies) for r in G.trophy_evolution(df).collect())
    assert weeks == [(dt.datetime(2024, 1, 1), 10), (dt.datetime(2024, 1, 8), 20)]


def test_dim_card_names_of_both_decks(spark):
    df = random_battles(spark, 5)
    names = {c for r in df.collect() for deck in (r.player_deck, r.opponent_deck) for c in deck or [] if c is not None}
    assert sorted(r.card_name for r in G.dim_card(df).collect()) == sorted(names)


def test_win_rate_by_deck_threshold(spark):
    rows = [("P", T0 + dt.timedelta(hours=i), "PvP", "win" if i < 3 else "loss", ["A"], 1.0, 1) for i in range(5)]
    rows += [("Q", T0 + dt.timedelta(hours=i), "PvP", "win", ["A"], 1.0, 1) for i in range(4)]
    out = G.win_rate_by_deck(battles(spark, rows)).collect()
    assert [(r.player_tag, r.total_battles, r.wins, r.win_rate) for r in out] == [("P", 5, 3, 60.0)]


def profiles(spark, rows):
    out = [(p, p.lower(), 1, tr, tr, w, l, n, "c", "t", 0.0, ts, ts.date()) for p, tr, w, l, n, ts in rows]
    return spark.createDataFrame(out, PROFILES)


def test_dim_player_latest_snapshot(spark):
    df = profiles(spark, [("A", 100, 1, 1, 2, T0), ("A", 200, 1, 1, 2, T0 + dt.timedelta(days=1)),
                          ("B", 50, 0, 0, 0, T0)])
    got = {r.player_tag: r.trophies for r in G.dim_player(df).collect()}
    assert got == {"A": 200, "B": 50}


def test_outcome_split_draws_never_negative(spark):
    df = profiles(spark, [("A", 1, 8, 5, 10, T0), ("B", 1, 3, 2, 10, T0), ("C", 1, 0, 0, 0, T0)])
    got = {r.player_tag: (r.wins, r.losses, r.draws, r.total_battles, r.win_pct) for r in A.outcome_split(df).collect()}
    assert got == {"A": (8, 5, 0, 10, 80.0), "B": (3, 2, 5, 10, 30.0), "C": (0, 0, 1, 1, 0.0)}


def test_latest_profile_and_trophies_by_date(spark):
    df = profiles(spark, [("A", 100, 1, 1, 2, T0), ("B", 300, 1, 1, 2, T0 + dt.timedelta(days=1)),
                          ("A", 200, 1, 1, 2, T0 + dt.timedelta(days=1))])
    assert A.latest_profile(df).first().player_tag == "A"  # same date and time: tie-break on tag
    rows = [(r.ingestion_date, r.unique_players, r.avg_trophies, r.max_trophies)
            for r in A.trophies_by_date(df).collect()]
    assert rows == [(dt.date(2024, 1, 2), 2, 250.0, 300), (dt.date(2024, 1, 1), 1, 100.0, 100)]
    asc = [r.ingestion_date for r in A.trophies_by_date_asc(df).collect()]
    assert asc == sorted(asc)


def test_coerce_result_roundtrip(spark):
    df = spark.createDataFrame([("2024-01-01", "12.5", "[A, B]"), ("bad", "x", "[]"), ("2024-01-02", "", None)],
                               "d string, n string, deck string")
    out = coerce_result(df, {"d": "date", "n": "number", "deck": "deck"}, order_by=["d"]).collect()
    assert [(r.d, r.n, r.deck) for r in out] == [(dt.date(2024, 1, 1), 12.5, ["A", "B"])]
    text = stringify(spark.createDataFrame([(None, ["A"])], "a int, b array<string>")).first()
    assert (text.a, text.b) == ("", "[A]")


def test_gold_from_state_equals_direct_gold(spark):
    from crownlake.plans import gold_state as GS

    df = random_battles(spark, 11)
    prof = profiles(spark, [("P1", 100, 1, 1, 2, T0), ("P1", 90, 1, 2, 3, T0 + dt.timedelta(days=2)),
                            ("P2", 50, 0, 0, 0, T0)])
    direct = G.gold_tables(df, prof)
    # partials by day, merged over the days
    partials = {**GS.battle_state(df), "player": GS.profile_state(prof)}
    merged = {n: GS.over_days(n, partials[n]) for n in GS.STATE_NAMES}
    for name, got in GS.gold_from_state(merged).items():
        want = direct[name]
        cols = sorted(want.columns)
        assert sorted(got.columns) == cols, name
        assert as_set(got.select(*cols)) == as_set(want.select(*cols)), name


def test_trophies_by_date_approx_players(spark):
    rows = [(f"P{i}", 100 + i, 1, 1, 2, T0) for i in range(200)]
    df = profiles(spark, rows)
    exact = A.trophies_by_date(df).first().unique_players
    approx = A.trophies_by_date(df, approx=True).first().unique_players
    assert exact == 200 and abs(approx - exact) <= 3 * 0.05 * exact  # within 3 standard deviations


def test_dim_player_by_time_keeps_a_player_without_times(spark):
    from pyspark.sql import functions as F

    from crownlake.plans.registry import dim_player_by_time

    df = profiles(spark, [("A", 100, 1, 1, 2, T0), ("A", 200, 1, 1, 2, T0 + dt.timedelta(days=1)), ("B", 50, 0, 0, 0, T0)])
    df = df.withColumn("snapshot_at", F.when(F.col("player_tag") != "B", F.col("snapshot_at")))
    want = sorted(G.dim_player(df).collect(), key=str)
    assert sorted(dim_player_by_time(df).collect(), key=str) == want and len(want) == 2


def test_dim_card_union_has_the_names_of_both_decks(spark):
    df = random_battles(spark, 5)
    names = {c for r in df.collect() for deck in (r.player_deck, r.opponent_deck) for c in deck or [] if c is not None}
    assert sorted(r.card_name for r in G.dim_card_union(df).collect()) == sorted(names)
