"""What a run of the pipeline leaves on disk, and what it moves: only what later steps read."""

from __future__ import annotations

import glob
import json
import os
import time

from pyspark.sql import functions as F

from conftest import rows
from crownlake.session import LEAN_DISK, lean_disk, scratch_path


def shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for f in glob.glob(f"{d.getPath()}/*/shuffle_*")}


def land(path, records):
    os.makedirs(path)
    with open(f"{path}/a.json", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)


def battle(tag, time):
    return {"battleTime": time, "type": "PvP", "player_tag": tag, "team": [{"crowns": 1, "cards": [{"name": "A"}]}],
            "opponent": [{"tag": "#X", "crowns": 0, "cards": [{"name": "B"}]}]}


def test_run_keeps_no_shuffle_files_or_scratch_and_lands_bronze_gzipped(spark, tmp_dir):
    from crownlake.plans.pipeline import Lake, read_gold, rejected_battles, run_pipeline

    lake, scratch = Lake(f"{tmp_dir}/lake"), os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    profile = {"tag": "#P", "name": "p", "expLevel": 1, "trophies": 1, "bestTrophies": 1, "wins": 1, "losses": 0, "battleCount": 1,
               "player_tag": "P"}
    twice = battle("P", "20240101T110000.000Z")
    land(f"{lake.raw_battles}/ingestion_date=2024-01-01", [battle("P", "20240101T100000.000Z"), twice, twice, battle("Q", None)])
    land(f"{lake.raw_profiles}/ingestion_date=2024-01-01", [profile])
    files, folders = shuffle_files(spark), set(glob.glob(f"{scratch}/*"))
    audit = {r.stage: r.rows for r in run_pipeline(spark, lake.root, "t_disk").collect()}
    assert (audit["bronze_battles"], audit["bronze_battle_rejects"], audit["silver_battles"]) == (3, 1, 2)
    for bronze in (lake.bronze_battles, lake.bronze_profiles):
        assert glob.glob(f"{bronze}/*/*.json.gz") and not glob.glob(f"{bronze}/*/*.json")
    assert set(glob.glob(f"{scratch}/*")) <= folders
    until = time.time() + 20  # the cleaner works beside the driver
    while (left := shuffle_files(spark) - files) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert rejected_battles(spark, lake).count() == 1
    assert rows(read_gold(spark, lake, "metrics_top_cards")) == [("P", "A", 2, 2, 100.0)]
    assert rows(read_gold(spark, lake, "metrics_win_rate_by_card").select("appearances")) == [(2,)]


def test_lean_disk_ends_with_the_session_as_it_was(spark):
    kept = "spark.sql.parquet.compression.codec"
    before = {k: spark.conf.get(k, None) for k in LEAN_DISK}
    spark.conf.set(kept, "gzip")
    try:
        with lean_disk(spark):
            outer = scratch_path(spark, "outer")
            assert spark.conf.get(kept) == "gzip"  # what the session sets, stays
            spark.range(3).write.parquet(outer)
            with lean_disk(spark):
                inner = scratch_path(spark, "inner")
                spark.range(3).write.parquet(inner)
            assert not os.path.exists(inner.removeprefix("file:")) and spark.read.parquet(outer).count() == 3
            assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
        assert not os.path.exists(outer.removeprefix("file:"))
    finally:
        spark.conf.unset(kept)
    assert {k: spark.conf.get(k, None) for k in LEAN_DISK} == {**before, kept: None}


def test_parts_that_meet_no_other_are_not_searched_for_late_players(spark):
    from crownlake.operators.streaks import interleaved

    def piece(player, part, low, high):
        return spark.sql(f"select '{player}' player_tag, {part} ingestion_date, named_struct('battle_time', timestamp_ntz '2024-01-{low:02d}', "
                         f"'battle_id', 'x') low, named_struct('battle_time', timestamp_ntz '2024-01-{high:02d}', 'battle_id', 'x') high")

    days = [f"date '2024-01-{d:02d}'" for d in (5, 10, 20)]
    stored = [piece("a", days[0], 1, 4), piece("b", days[0], 1, 7), piece("a", days[1], 5, 9), piece("b", days[1], 7, 9),
              piece("c", "cast(null as date)", 8, 9), piece("c", days[1], 9, 9), piece("a", days[2], 12, 19), piece("b", days[2], 12, 19)]
    all_of = stored[0]
    for s in stored[1:]:
        all_of = all_of.unionByName(s)
    assert rows(interleaved(all_of, "ingestion_date")) == [("b",), ("c",)]
    assert interleaved(all_of.where(F.col("ingestion_date") == F.lit("2024-01-20").cast("date")), "ingestion_date").isEmpty()


def test_profile_cards_count_lines_and_orders(spark, tmp_dir):
    """Orders whose key comes twice join their lines twice, but are one order of a card."""
    from crownlake.sources import raw as R

    def table(name, sql):
        spark.sql(sql).write.parquet(f"{tmp_dir}/{name}.parquet")

    table("customer", "select 1L c_custkey, 'Customer#1' c_name, 3 c_nationkey, 'M' c_mktsegment")
    table("part", "select * from values (1L, 'T', 'b', 5), (2L, 'T', 'a', 9) as t(p_partkey, p_type, p_brand, p_size)")
    table("orders", "select k o_orderkey, 1L o_custkey, timestamp_ntz '1995-02-03' o_orderdate, 'F' o_orderstatus, 10.0D o_totalprice "
                    "from values (1L), (1L), (2L) as t(k)")
    table("lineitem", "select * from values (1L, 1L, 1), (1L, 2L, 2), (2L, 2L, 7) as t(l_orderkey, l_partkey, l_linenumber)")
    cards = [[tuple(c) for c in r.cards] for r in R.raw_profiles(spark, tmp_dir).collect()]
    assert cards == [[(1, "T", 5, 7, "a", 5, 2)]]
