"""Property tests (Hypothesis): each example set runs as one Spark job."""

from __future__ import annotations

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from crownlake.functions import columns as X

CARD = st.text(alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefgh.-'", min_size=1, max_size=12).filter(
    lambda s: s == s.strip())
DECKS = st.lists(st.lists(CARD, min_size=1, max_size=8), min_size=1, max_size=20)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(decks=DECKS, seed=st.integers(0, 10_000))
def test_deck_hash_ignores_card_order(spark, decks, seed):
    rng = random.Random(seed)
    shuffled = [rng.sample(d, len(d)) for d in decks]
    df = spark.createDataFrame(list(zip(decks, shuffled)), "a array<string>, b array<string>")
    out = df.select((X.deck_hash("a") == X.deck_hash("b")).alias("same")).collect()
    assert all(r.same for r in out)


@SETTINGS
@given(decks=DECKS)
def test_parse_deck_inverts_render_deck(spark, decks):
    df = spark.createDataFrame([(d,) for d in decks], "d array<string>")
    out = df.select("d", X.parse_deck(X.render_deck("d")).alias("back")).collect()
    assert all(r.d == r.back for r in out)


@SETTINGS
@given(tags=st.lists(st.text(alphabet="#abcXYZ019 \t", max_size=10), min_size=1, max_size=20))
def test_clean_tag_matches_python_and_is_idempotent(spark, tags):
    df = spark.createDataFrame([(t,) for t in tags], "t string")
    out = df.select("t", X.clean_tag("t").alias("c"), X.clean_tag(X.clean_tag("t")).alias("cc")).collect()
    for r in out:
        assert r.c == r.t.replace("#", "").upper().strip()
        assert r.cc == r.c


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 500), st.integers(0, 500)), min_size=1, max_size=30))
def test_pct_is_rounded_ratio(spark, pairs):
    df = spark.createDataFrame(pairs, "w int, n int")
    out = df.select("w", "n", X.guarded_pct("w", "n").alias("p")).collect()
    for r in out:
        expected = 0.0 if r.n <= 0 else r.w / r.n * 100
        assert abs(r.p - expected) <= 0.005 + 1e-9
