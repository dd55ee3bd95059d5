"""Shapes of plans and stored files that keep the work in proportion to the input."""

from __future__ import annotations

import glob

import numpy as np

from conftest import SF_SMALL, rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_landing_is_parsed_once_a_row(spark, tmp_dir):
    from crownlake.operators.bronze import normalize_battles
    from crownlake.sources import raw as R

    items = R.raw_battle_items(spark, SF_SMALL)
    R.land_json_text(items, f"{tmp_dir}/t")
    R.land_json(items, f"{tmp_dir}/j")
    kept, _ = normalize_battles(R.read_raw_battles_text(spark, f"{tmp_dir}/t"))
    assert plan(kept).count("from_json(") == 1
    assert rows(kept) == rows(normalize_battles(R.read_raw_battles(spark, f"{tmp_dir}/j"))[0])


def test_landed_json_is_gzipped_and_plain_files_are_read_beside_it(spark, tmp_dir):
    from crownlake.sources import raw as R

    items = R.raw_battle_items(spark, SF_SMALL)
    R.land_json(items, tmp_dir)
    assert glob.glob(f"{tmp_dir}/*/*.json.gz") and not glob.glob(f"{tmp_dir}/*/*.json")
    day = items.where("ingestion_date is not null").first()["ingestion_date"]
    with open(f"{tmp_dir}/ingestion_date={day}/plain.json", "w") as f:
        f.write('{"battleTime": "20240101T100000.000Z", "player_tag": "PLAIN"}\n')
    read = R.read_raw_battles(spark, tmp_dir)
    assert read.count() == items.count() + 1 and read.where("player_tag = 'PLAIN'").count() == 1


def test_decks_are_not_shuffled_by_customer_or_with_their_hash(spark):
    from crownlake.sources import fixtures as FX

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = FX.battles(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.splitlines()

    def depth(part: str) -> int:
        return next(line.index("Join") for line in lines if "Join" in line and part in line)

    assert depth("(o_custkey") > depth("(o_orderkey")
    assert "deck_hash" not in next(line for line in lines if "Aggregate [battle_id" in line)


def test_steps_of_trophies_sort_nothing_globally(spark):
    from crownlake.plans import registry

    assert "rangepartitioning" not in plan(registry.all_queries()["trophy_steps"](spark, SF_SMALL))


def test_waves_are_landed_from_items_built_once(spark):
    from crownlake.plans import registry
    from crownlake.sources import raw as R

    items, built = registry._items_once(spark, SF_SMALL), R.raw_battle_items(spark, SF_SMALL)
    assert plan(items).count("FileScan") == 1 and items.schema.names == built.schema.names
    assert rows(items) == rows(built)


def test_keys_seen_decide_how_new_rows_are_joined(spark, monkeypatch):
    from crownlake.operators import dedup

    new = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, t int")
    old = spark.createDataFrame([("b", 2), ("c", 2), (None, 3)], "k string, t int")
    assert "Join" not in plan(dedup.drop_seen(new, old.where("k = 'c'"), ["k"], "t"))
    few = rows(dedup.drop_seen(new, old, ["k"], "t"))
    monkeypatch.setattr(dedup, "BROADCAST_KEYS", -1)
    many = dedup.drop_seen(new, old, ["k"], "t")
    assert "LeftSemi" in plan(many) and rows(many) == few == [("a", 1)]


def test_segments_carry_places_after_the_first_exchange_only(spark):
    from crownlake.operators.streaks import segments

    df = spark.sql("select 'P' player_tag, timestamp_ntz '2024-01-01' battle_time, 'x' battle_id, 'win' result, date '2024-01-01' d")
    first = next(line for line in reversed(plan(segments(df, "d")).splitlines()) if "Project" in line or "Scan" in line)
    assert "_low" not in first and segments(df, "d").first()["low"]["battle_id"] == "x"


def test_grown_sketches_are_held_a_few_at_a_time(monkeypatch):
    from crownlake.llm import fingerprints as P

    held = []
    start = P.Sketches.__init__

    def counted(self, sets, cells):
        held.append((len(sets), cells))
        start(self, sets, cells)

    monkeypatch.setattr(P.Sketches, "__init__", counted)
    rng = np.random.default_rng(1)
    left = [rng.integers(1, 1 << 62, 400).astype(np.uint64) for _ in range(64)]
    right = [np.append(s[:100], rng.integers(1, 1 << 62, 300).astype(np.uint64)) for s in left]
    assert np.allclose(P.likeness(left, right), 100 / 700)
    assert max(n * cells for n, cells in held if n > 1) <= P.BLOCK * P.CELLS
