"""Keyed dedup: survivor choice, hot keys, map-side reduction, incremental merge."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownlake.operators.analytics import LATEST_PROFILE_COLUMNS, latest_profile
from crownlake.operators import dedup
from crownlake.operators.dedup import drop_seen, keep_first, keep_first_stored, keep_last

from conftest import rows


def test_keep_first_and_last_by_order_then_row(spark):
    df = spark.createDataFrame(
        [("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), ("j", 5, "x")], "key string, ord int, v string")
    assert rows(keep_first(df, ["key"], ["ord"])) == [("j", 5, "x"), ("k", 1, "a")]
    assert rows(keep_last(df, ["key"], ["ord"])) == [("j", 5, "x"), ("k", 2, "b")]


def test_hot_key_is_reduced_map_side(spark):
    hot = [("HOT", i % 97, f"v{i}") for i in range(5000)]
    cold = [(f"c{i}", 0, "x") for i in range(50)]
    df = spark.createDataFrame(hot + cold, "key string, ord int, v string").repartition(8)
    out = keep_first(df, ["key"], ["ord"])
    got = dict((r.key, (r.ord, r.v)) for r in out.collect())
    assert got["HOT"] == (0, "v0") and len(got) == 51
    plan = out._jdf.queryExecution().executedPlan().toString()
    # a partial aggregate below the shuffle: each task reduces its share of the hot key first
    assert "partial_min" in plan


def test_null_keys_group_together(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "key string, ord int")
    assert rows(keep_first(df, ["key"], ["ord"])) == [("a", 3), (None, 1)]


def test_drop_seen(spark):
    existing = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    new = spark.createDataFrame([("b", 1), ("d", 2), ("d", 3), ("e", 4)], "id string, x int")
    assert rows(drop_seen(new, existing, ["id"])) == [("d", 2), ("d", 3), ("e", 4)]


def test_drop_seen_probes_the_large_side_without_shuffling_it(spark):
    existing = spark.range(200_000).selectExpr("cast(id as string) as id").repartition(8)
    new = spark.createDataFrame([("5",), ("x",)], "id string")
    out = drop_seen(new, existing, ["id"])
    assert [r.id for r in out.collect()] == ["x"]
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the (small) new keys are the broadcast side of the semi join
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_drop_seen_takes_null_keys_as_equal_and_compares_within_the_range(spark):
    kind = "tag string, at timestamp_ntz"
    at = [dt.datetime(2024, 1, d, 12, 30, 0, 123456) for d in range(1, 6)]
    existing = spark.createDataFrame([("a", at[0]), ("a", at[2]), ("a", None), (None, at[3])], kind)
    new = spark.createDataFrame([("a", at[2]), ("a", None), (None, at[3]), ("b", at[4]), ("b", None)], kind)
    for within in (None, "at"):
        assert rows(drop_seen(new, existing, ["tag", "at"], within=within)) == [("b", None), ("b", at[4])]
    only_null = spark.createDataFrame([("a", None), ("c", None)], kind)
    assert rows(drop_seen(only_null, existing, ["tag", "at"], within="at")) == [("c", None)]
    assert rows(drop_seen(new.limit(0), existing, ["tag", "at"], within="at")) == []


def test_latest_profile_reads_the_newest_partition_only(spark, tmp_dir):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame(
        [(f"P{i}", i, dt.datetime(2024, 1, 1), day) for i in range(4) for day in days],
        "player_tag string, trophies int, snapshot_at timestamp_ntz, ingestion_date date")
    other = [c for c in LATEST_PROFILE_COLUMNS if c not in df.columns]
    df.select("*", *[F.lit(None).cast("int").alias(c) for c in other]).write.partitionBy("ingestion_date").parquet(f"{tmp_dir}/p")
    out = latest_profile(spark.read.parquet(f"{tmp_dir}/p"))
    assert [(r.player_tag, r.ingestion_date) for r in out.collect()] == [("P0", days[-1])]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*ingestion_date[^\]]*Subquery", plan)


def test_stored_rows_of_unrepeated_keys_are_not_shuffled(spark, monkeypatch):
    """F8: the stream's batches shuffled and sorted every wide row for the few that repeat."""
    data = [(f"k{i}", i % 5, f"v{i}") for i in range(300)]
    data += [("k7", 0, "a"), ("k7", 0, "b"), (None, 2, "n"), (None, 1, "m"), ("k9", None, None), ("k9", None, None)]
    df = spark.createDataFrame(data, "key string, ord int, v string").repartition(6)
    want = rows(keep_first(df, ["key"], ["ord"]))
    few = keep_first_stored(df.where("key <> 'none'").unionByName(df.where("key IS NULL")), ["key"], ["ord"])
    assert few.columns == df.columns and rows(few) == want and len(want) == 301
    alone = spark.range(50).selectExpr("id", "cast(id as string) AS v")
    assert keep_first_stored(alone, ["id"]) is alone
    assert "Aggregate" not in few._jdf.queryExecution().optimizedPlan().toString()
    # So many repeat that their hashes can't be broadcast.
    monkeypatch.setattr(dedup, "BROADCAST_KEYS", 0)
    assert rows(keep_first_stored(df, ["key"], ["ord"])) == want


def test_stream_batches_keep_the_first_landing_of_repeats(spark, tmp_dir):
    """F8: a batch whose repeats are few, one whose repeats are many, and one that repeats both."""
    from crownlake.operators.bronze import normalize_battles
    from crownlake.operators.silver import silver_battles
    from crownlake.sources import raw as R
    from crownlake.streaming.ingest import run_available_now

    def item(tag, minute, kind):
        side = [{"tag": "#O", "crowns": 1, "startingTrophies": 5, "cards": [{"name": "b"}, {"name": "a"}]}]
        return {"battleTime": f"20240601T10{minute:02d}00.000Z", "type": kind, "team": side, "opponent": side,
                "player_tag": tag, "ingested_at": None, "ingestion_date": dt.date(2024, 6, 1)}

    schema = T.StructType(R.RAW_BATTLE_LANDED.fields + [T.StructField("ingestion_date", T.DateType())])
    waves = [[item("A", m, "PvP") for m in range(20)] + [item("A", 3, "Ladder")], [item("B", m % 4, k) for m in range(12) for k in "yx"]]
    waves.append(waves[0] + waves[1])
    for wave in waves:
        R.land_json(spark.createDataFrame(wave, schema).repartition(3), f"{tmp_dir}/raw", mode="append", few_days=True)
        run_available_now(spark, f"{tmp_dir}/raw", f"{tmp_dir}/silver", f"{tmp_dir}/ckpt")
    got = spark.read.parquet(f"{tmp_dir}/silver")
    want = silver_battles(normalize_battles(R.read_raw_battles(spark, f"{tmp_dir}/raw"))[0])
    assert rows(got, *want.columns) == rows(want, *want.columns) and got.count() == 24
