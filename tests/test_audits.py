"""Schema drift (S11), sorted files (O6), sketches (A7) and the window form of the latest row."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownlake.operators import gold as G
from crownlake.operators import sketches as SK
from crownlake.sources import drift
from crownlake.sources import sinks as K

DECLARED = (
    T.StructType().add("a", "integer").add("b", "double").add("c", "string")
    .add("d", T.StructType().add("e", "integer").add("f", "string")).add("g", T.ArrayType(T.StructType().add("h", "integer"))).add("k", "boolean")
)


def land(base, day, records, multi_line=False):
    folder = f"{base}/ingestion_date={day}"
    os.makedirs(folder)
    with open(f"{folder}/x.json", "w") as f:
        f.write(json.dumps(records, indent=1) if multi_line else "\n".join(json.dumps(r) for r in records))


def differences(spark, base, **options):
    rows = drift.schema_drift(spark, base, DECLARED, **options).collect()
    return sorted((str(r.ingestion_date), r.field, r.change, r.declared, r.landed) for r in rows)


GOOD = {"a": 1, "b": 1.5, "c": "x", "d": {"e": 1, "f": "y"}, "g": [{"h": 1}], "k": True}


def test_drift_of_each_kind(spark, tmp_dir):
    base = f"{tmp_dir}/landing"
    land(base, "2024-01-01", [GOOD, GOOD | {"b": 2, "g": []}, GOOD | {"c": None}])
    land(base, "2024-01-02", [{**GOOD, "new": {"x": 1}, "d": {"e": "1", "f": "y", "z": 3}}])
    land(base, "2024-01-03", [{"a": 1.5, "b": "t", "d": {"e": 1}, "g": {"h": 1}, "k": True}])
    land(base, "2024-01-04", [])
    land(base, "2024-01-05", [{k: None for k in GOOD}])
    land(base, "2024-01-06", [GOOD | {"g": []}])
    assert differences(spark, base) == [
        ("2024-01-02", "d.e", "changed", "int", "string"),
        ("2024-01-02", "d.z", "added", None, "bigint"),
        ("2024-01-02", "new", "added", None, "object"),
        ("2024-01-03", "a", "changed", "int", "decimal(2,1)"),
        ("2024-01-03", "b", "changed", "double", "string"),
        ("2024-01-03", "c", "missing", "string", None),
        ("2024-01-03", "d.f", "missing", "string", None),
        ("2024-01-03", "g", "changed", "array", "object"),
    ]


def test_drift_of_documents_and_bad_records(spark, tmp_dir):
    land(f"{tmp_dir}/docs", "2024-01-01", [GOOD, GOOD | {"extra": 1}], multi_line=True)
    assert differences(spark, f"{tmp_dir}/docs", multi_line=True) == [("2024-01-01", "extra", "added", None, "bigint")]
    os.makedirs(f"{tmp_dir}/bad/ingestion_date=2024-01-01")
    with open(f"{tmp_dir}/bad/ingestion_date=2024-01-01/x.json", "w") as f:
        f.write('{"a": \n' + json.dumps(GOOD))
    assert differences(spark, f"{tmp_dir}/bad") == []


def test_order_check_fails_without_the_sort(spark, tmp_dir):
    df = spark.range(5000).selectExpr("concat('p', id * 7919 % 5000) AS player_tag", "id % 13 AS week", "id AS n").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files, however small
    try:
        K.write_sorted(df, f"{tmp_dir}/sorted", ["player_tag", "week"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    checked = K.checked_order(spark, f"{tmp_dir}/sorted", ["player_tag", "week"])
    assert checked.columns == ["player_tag", "week", "n", "in_order"]
    assert checked.where("in_order").count() == 5000 and len(checked.inputFiles()) > 1
    df.write.parquet(f"{tmp_dir}/unsorted")
    assert K.checked_order(spark, f"{tmp_dir}/unsorted", ["player_tag", "week"]).where("NOT in_order").count() > 1000
    # Sorted files whose ranges overlap are not in order either.
    df.sortWithinPartitions("player_tag", "week").write.parquet(f"{tmp_dir}/overlapping")
    assert K.checked_order(spark, f"{tmp_dir}/overlapping", ["player_tag", "week"]).where("NOT in_order").count() > 0


def test_sketches_of_any_days(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    rows = [(days[i % 6], f"p{(i * 31) % 4000}", i) for i in range(20000)] + [(days[5], None, 1)]
    profiles = spark.createDataFrame(rows, "ingestion_date date, player_tag string, trophies int")
    sketches = SK.player_sketches(profiles)
    for lo, hi in ((None, None), (days[1], days[3]), (days[4], days[4])):
        inside = {p for d, p, _ in rows if p and (lo is None or d >= lo) and (hi is None or d <= hi)}
        estimate = SK.players_between(sketches, lo, hi).first().players
        assert abs(estimate - len(inside)) <= 3 * SK.DEVIATION * len(inside)
    assert SK.players_between(sketches, dt.date(2030, 1, 1)).first().players == 0
    exact = {r.ingestion_date: r.players for r in SK.exact_players_to_date(profiles).collect()}
    assert exact == {d: len({p for x, p, _ in rows if p and x <= d}) for d in days}
    near = {r.ingestion_date: r.estimate for r in SK.players_to_date(sketches).collect()}
    assert all(abs(near[d] - n) <= 3 * SK.DEVIATION * n for d, n in exact.items())


def test_latest_row_by_window_is_limited_before_the_exchange(spark):
    base = "player_name string, level int, trophies int, best_trophies int, wins int, losses int, battle_count int, win_rate double"
    schema = f"player_tag string, {base}, clan_name string, clan_tag string, snapshot_at timestamp_ntz"
    t = dt.datetime(2024, 1, 1)

    def row(tag, level, time):
        return (tag, "n", level, 1, 1, 1, 1, 1, 0.5, None, None, time)

    rows = [row("A", 1, t), row("A", 2, t), row("A", 9, None), row("B", 1, None), row("B", 3, None), row(None, 1, t), row(None, 2, None)]
    profiles = spark.createDataFrame(rows, schema)
    got = G.dim_player_window(profiles)
    assert sorted((r.player_tag or "", r.level) for r in got.collect()) == [("", 1), ("A", 2), ("B", 3)]
    assert sorted(map(str, got.collect())) == sorted(map(str, G.dim_player(profiles).collect()))
    text = G.dim_player_window(profiles)._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text
