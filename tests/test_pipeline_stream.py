"""Pipeline (write -> register -> repair -> query), incremental runs and streaming."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from crownlake.plans.pipeline import Lake, read_gold, run_pipeline
from crownlake.sources import raw as R
from crownlake.streaming.ingest import run_available_now

from conftest import SF_SMALL


def as_set(df, *cols):
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=repr)


def landed_days(df):
    return sorted(r.ingestion_date for r in df.select("ingestion_date").distinct().collect())


def test_full_pipeline_registers_and_repairs(spark, tmp_dir):
    lake = Lake(tmp_dir)
    R.land_json(R.raw_battle_items(spark, SF_SMALL), lake.raw_battles)
    R.land_json(R.raw_profiles(spark, SF_SMALL), lake.raw_profiles)
    audit = {r.stage: r.rows for r in run_pipeline(spark, tmp_dir, database="t_full").collect()}
    silver = spark.read.parquet(lake.silver_battles)
    assert audit["silver_battles"] == silver.count() > 0
    assert audit["bronze_battles"] >= audit["silver_battles"]
    assert audit["bronze_battle_rejects"] == 0
    # registered + repaired: every partition is visible through the catalogue
    assert spark.table("t_full.battles_silver").count() == audit["silver_battles"]
    assert spark.table("t_full.fact_battles").count() == audit["fact_battles"]
    assert spark.table("t_full.profile_silver").count() == audit["silver_profiles"]
    assert {"t_full"} <= set(d.name for d in spark.catalog.listDatabases())
    # the X3 shortcut: usage equals the per-card win-rate table
    a = as_set(spark.table("t_full.metrics_top_cards"), "player_tag", "card_name", "usage_count")
    b = as_set(spark.table("t_full.metrics_win_rate_by_card"), "player_tag", "card_name", "appearances")
    assert a == b


def test_incremental_equals_one_batch_and_is_idempotent(spark, tmp_dir):
    items = R.raw_battle_items(spark, SF_SMALL)
    profiles = R.raw_profiles(spark, SF_SMALL)
    days = landed_days(items)
    first, second = days[:-2], days[-2:]
    # one re-landing of already-seen battles on a later day (a repeated battle log)
    repeat = items.where(F.col("ingestion_date") == first[0]).limit(5).withColumn(
        "ingestion_date", F.lit(second[-1]))

    inc = Lake(os.path.join(tmp_dir, "inc"))
    R.land_json(items.where(F.col("ingestion_date").isin(first)), inc.raw_battles)
    R.land_json(profiles.where(F.col("ingestion_date").isin(first)), inc.raw_profiles)
    run_pipeline(spark, inc.root, database="t_inc")
    R.land_json(items.where(F.col("ingestion_date").isin(second)).unionByName(repeat), inc.raw_battles,
                mode="append")
    R.land_json(profiles.where(F.col("ingestion_date").isin(second)), inc.raw_profiles, mode="append")
    run_pipeline(spark, inc.root, database="t_inc", days=second, incremental=True)
    after_once = as_set(spark.read.parquet(inc.silver_battles))
    run_pipeline(spark, inc.root, database="t_inc", days=second, incremental=True)
    assert as_set(spark.read.parquet(inc.silver_battles)) == after_once

    full = Lake(os.path.join(tmp_dir, "full"))
    R.land_json(items.unionByName(repeat), full.raw_battles)
    R.land_json(profiles, full.raw_profiles)
    run_pipeline(spark, full.root, database="t_one")
    assert after_once == as_set(spark.read.parquet(full.silver_battles))
    assert spark.table("t_inc.fact_battles").count() == len(after_once)
    # gold merged from state equals gold rebuilt from all of silver
    from crownlake.operators.gold import GOLD_TABLE_NAMES
    for name in GOLD_TABLE_NAMES:
        inc_t, full_t = read_gold(spark, inc, name), read_gold(spark, full, name)
        cols = sorted(full_t.columns)
        assert as_set(inc_t, *cols) == as_set(full_t, *cols), name


def write_items(path, items):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for it in items:
            f.write(json.dumps(it) + "\n")


def item(tag, time, crowns=(1, 0)):
    return {"battleTime": time, "type": "PvP", "player_tag": tag,
            "team": [{"crowns": crowns[0], "cards": [{"name": "A"}]}],
            "opponent": [{"tag": "#X", "crowns": crowns[1], "cards": [{"name": "B"}]}]}


def test_available_now_reads_new_files_not_rewritten_ones(spark, tmp_dir):
    raw, silver, ckpt = (os.path.join(tmp_dir, p) for p in ("raw", "silver", "ckpt"))
    day = os.path.join(raw, "ingestion_date=2024-01-01")
    write_items(os.path.join(day, "pull-1.json"), [item("P", "20240101T100000.000Z"), item("P", "20240101T110000.000Z")])
    run_available_now(spark, raw, silver, ckpt)
    assert spark.read.parquet(silver).count() == 2
    # a new pull under a new name is picked up; a repeated battle in it is not added twice
    write_items(os.path.join(day, "pull-2.json"), [item("P", "20240101T110000.000Z"), item("P", "20240101T120000.000Z")])
    run_available_now(spark, raw, silver, ckpt)
    assert spark.read.parquet(silver).count() == 3
    # the same path rewritten in place is not read again
    write_items(os.path.join(day, "pull-1.json"), [item("P", "20240101T130000.000Z")])
    run_available_now(spark, raw, silver, ckpt)
    assert spark.read.parquet(silver).count() == 3


def test_reader_accepts_json_lines_and_arrays(spark, tmp_dir):
    write_items(os.path.join(tmp_dir, "T1", "2024-02-02", "data.json"), [item(None, "20240202T000000.000Z")])
    os.makedirs(os.path.join(tmp_dir, "T2", "2024-02-03"))
    with open(os.path.join(tmp_dir, "T2", "2024-02-03", "data.json"), "w") as f:
        f.write(json.dumps([item(None, "20240203T000000.000Z"), item(None, "20240203T010000.000Z")]))
    got = sorted((r.player_tag, r.ingestion_date) for r in R.read_raw_battles(spark, tmp_dir).collect())
    assert got == [("T1", dt.date(2024, 2, 2)), ("T2", dt.date(2024, 2, 3)), ("T2", dt.date(2024, 2, 3))]


def test_command_line_pipeline_and_stream(spark, tmp_dir, capsys):
    from crownlake.__main__ import main

    lake = Lake(tmp_dir)
    R.land_json(R.raw_battle_items(spark, SF_SMALL), lake.raw_battles)
    R.land_json(R.raw_profiles(spark, SF_SMALL), lake.raw_profiles)
    assert main(["pipeline", "--root", tmp_dir, "--database", "t_cli"]) == 0
    printed = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert int(printed["silver_battles"]) == spark.table("t_cli.battles_silver").count()
    before = spark.read.parquet(lake.silver_battles).count()
    assert main(["stream", "--root", tmp_dir]) == 0  # everything already in silver: adds nothing
    assert spark.read.parquet(lake.silver_battles).count() == before


@pytest.mark.parametrize("writes", [1, 2, 5, 8, 13, 16])
def test_run_stopped_after_any_write_can_be_repeated(spark, tmp_dir, monkeypatch, writes):
    from crownlake.operators.gold import GOLD_TABLE_NAMES
    from crownlake.sources import sinks as K

    lake = Lake(os.path.join(tmp_dir, "stopped"))
    day = {n: os.path.join(lake.raw_battles, f"ingestion_date=2024-01-0{n}") for n in (1, 2)}
    profile = {"tag": "#P", "name": "p", "expLevel": 1, "trophies": 1, "bestTrophies": 1, "wins": 1, "losses": 0,
               "battleCount": 1, "player_tag": "P"}
    write_items(os.path.join(day[1], "a.json"), [item("P", "20240101T100000.000Z"), item("P", "20240101T110000.000Z")])
    write_items(os.path.join(lake.raw_profiles, "ingestion_date=2024-01-01", "a.json"), [profile])
    run_pipeline(spark, lake.root, database="t_stopped")
    # the second day has battles only, one of them seen before
    write_items(os.path.join(day[2], "a.json"), [item("P", "20240101T110000.000Z"), item("P", "20240102T110000.000Z")])
    write, left = K.write_parquet, [writes]

    def failing(*args, **kwargs):
        out = write(*args, **kwargs)
        left[0] -= 1
        if left[0] == 0:
            raise RuntimeError("stopped")
        return out

    second = [dt.date(2024, 1, 2)]
    with monkeypatch.context() as m:
        m.setattr(K, "write_parquet", failing)
        with pytest.raises(RuntimeError):
            run_pipeline(spark, lake.root, database="t_stopped", days=second, incremental=True)
    run_pipeline(spark, lake.root, database="t_stopped", days=second, incremental=True)
    got = {n: as_set(read_gold(spark, lake, n)) for n in GOLD_TABLE_NAMES}
    assert read_gold(spark, lake, "dim_deck").selectExpr("sum(total_battles)").first()[0] == 3
    run_pipeline(spark, lake.root, database="t_stopped")
    for name, rows in got.items():
        assert rows == as_set(read_gold(spark, lake, name)), name


def test_rejects_land_in_bronze_with_reason_in_one_pass(spark, tmp_dir):
    from crownlake.plans.pipeline import rejected_battles

    lake = Lake(tmp_dir)
    day = os.path.join(lake.raw_battles, "ingestion_date=2024-01-01")
    bad = item("P", "20240101T110000.000Z")
    bad["team"] = []
    write_items(os.path.join(day, "pull.json"), [item("P", "20240101T100000.000Z"), bad])
    pday = os.path.join(lake.raw_profiles, "ingestion_date=2024-01-01")
    write_items(os.path.join(pday, "pull.json"), [{
        "tag": "#P", "name": "p", "expLevel": 1, "trophies": 1, "bestTrophies": 1, "wins": 1, "losses": 0,
        "battleCount": 1, "player_tag": "P"}])
    audit = {r.stage: r.rows for r in run_pipeline(spark, tmp_dir, database="t_rej").collect()}
    assert (audit["bronze_battles"], audit["bronze_battle_rejects"], audit["silver_battles"]) == (1, 1, 1)
    assert [r.reject_reason for r in rejected_battles(spark, lake).collect()] == ["missing team"]


def test_stream_into_lake_keeps_gold_state_complete(spark, tmp_dir):
    from crownlake.operators.gold import GOLD_TABLE_NAMES

    items = R.raw_battle_items(spark, SF_SMALL)
    profiles = R.raw_profiles(spark, SF_SMALL)
    days = landed_days(items)
    first, second = days[:-2], days[-2:]
    lake = Lake(os.path.join(tmp_dir, "mixed"))
    R.land_json(items.where(F.col("ingestion_date").isin(first)), lake.raw_battles)
    R.land_json(profiles.where(F.col("ingestion_date").isin(first)), lake.raw_profiles)
    run_pipeline(spark, lake.root, database="t_mixed")
    R.land_json(items.where(F.col("ingestion_date").isin(second)), lake.raw_battles, mode="append")
    run_available_now(spark, lake.raw_battles, lake.silver_battles, os.path.join(tmp_dir, "ck"), lake=lake)

    full = Lake(os.path.join(tmp_dir, "full"))
    R.land_json(items, full.raw_battles)
    R.land_json(profiles.where(F.col("ingestion_date").isin(first)), full.raw_profiles)
    run_pipeline(spark, full.root, database="t_mixed_full")
    assert as_set(spark.read.parquet(lake.silver_battles)) == as_set(spark.read.parquet(full.silver_battles))
    for name in GOLD_TABLE_NAMES:
        a, b = read_gold(spark, lake, name), read_gold(spark, full, name)
        cols = sorted(b.columns)
        assert as_set(a, *cols) == as_set(b, *cols), name


def test_command_line_auto_size(spark, tmp_dir):
    from crownlake.__main__ import main

    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]
    saved = {k: spark.conf.get(k) for k in keys}
    lake = Lake(tmp_dir)
    R.land_json(R.raw_battle_items(spark, SF_SMALL), lake.raw_battles)
    R.land_json(R.raw_profiles(spark, SF_SMALL), lake.raw_profiles)
    try:
        assert main(["pipeline", "--root", tmp_dir, "--database", "t_cli_size", "--auto-size"]) == 0
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"  # small input: the floor
        assert spark.table("t_cli_size.fact_battles").count() > 0
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
