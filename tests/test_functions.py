"""Column helpers (F-rows of SURVEY §2.8) on hand-written rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from crownlake.functions import columns as X


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("out")).first()["out"]


def test_clean_tag_variants(spark):
    df = spark.createDataFrame([("#2pqly9",), ("2PQLY9",), (" 2pqly9 ",), ("#2P#QLY9",)], "t string")
    assert [r.out for r in df.select(X.clean_tag("t").alias("out")).collect()] == ["2PQLY9"] * 4


def test_strip_mark_keeps_case(spark):
    assert one(spark, X.strip_mark("v"), "#abC") == "abC"


def test_parse_api_time_valid_bad_null(spark):
    df = spark.createDataFrame([("20240115T123456.789Z",), ("garbage",), (None,)], "v string")
    out = [r.t for r in df.select(X.parse_api_time("v").alias("t")).collect()]
    assert out == [dt.datetime(2024, 1, 15, 12, 34, 56, 789000), None, None]


def test_parse_api_time_independent_of_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        t = one(spark, X.parse_api_time("v"), "20240115T000000.000Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert t == dt.datetime(2024, 1, 15, 0, 0, 0)


def test_render_then_parse_roundtrip(spark):
    ts = dt.datetime(2023, 7, 1, 5, 6, 7, 250000)
    df = spark.createDataFrame([(ts,)], "v timestamp_ntz")
    assert df.select(X.parse_api_time(X.render_api_time("v")).alias("t")).first().t == ts


def test_deck_hash_ignores_order_and_handles_null_and_empty(spark):
    df = spark.createDataFrame(
        [(["A", "B", "C"],), (["C", "A", "B"],), (None,), ([],), (["X"],)], "d array<string>")
    h = [r.h for r in df.select(X.deck_hash("d").alias("h")).collect()]
    assert h[0] == h[1]
    assert h[2] is None
    import hashlib
    assert h[3] == hashlib.md5(b"").hexdigest()
    assert h[4] == hashlib.md5(b"X").hexdigest()


def test_battle_id_matches_md5_of_tag_and_time(spark):
    import hashlib
    df = spark.createDataFrame([("P1", dt.datetime(2024, 1, 1, 0, 0, 0))], "p string, t timestamp_ntz")
    got = df.select(X.battle_id("p", "t").alias("b")).first().b
    assert got == hashlib.md5(b"P1_2024-01-01 00:00:00").hexdigest()


def test_parse_deck_cases(spark):
    df = spark.createDataFrame([("[A, B]",), ("[]",), ("A, B",), (None,)], "v string")
    out = [r.d for r in df.select(X.parse_deck("v").alias("d")).collect()]
    assert out == [["A", "B"], [""], [], []]


def test_render_deck(spark):
    assert one(spark, X.render_deck("v"), ["A", "B"], "v array<string>") == "[A, B]"


def test_to_number_and_date(spark):
    df = spark.createDataFrame([("12.5",), ("x",), ("",)], "v string")
    assert [r.n for r in df.select(X.to_number("v").alias("n")).collect()] == [12.5, None, None]
    dd = spark.createDataFrame([("2024-02-03",), ("nope",)], "v string")
    assert [r.d for r in dd.select(X.to_date_or_null("v").alias("d")).collect()] == [dt.date(2024, 2, 3), None]


def test_falsy_default_and_clamp(spark):
    df = spark.createDataFrame([(None,), (0,), (7,)], "v int")
    assert [r.o for r in df.select(X.falsy_default("v", 1).alias("o")).collect()] == [1, 1, 7]
    assert one(spark, X.clamp_at_zero(F.col("v") - 5), 3, "v int") == 0


def test_pct_and_guarded_pct(spark):
    df = spark.createDataFrame([(2, 3), (1, 0), (0, 0)], "w int, n int")
    out = [r.p for r in df.select(X.guarded_pct("w", "n").alias("p")).collect()]
    assert out == [66.67, 0.0, 0.0]


def test_result_from_crowns(spark):
    df = spark.createDataFrame([(3, 1), (1, 3), (1, 1)], "a int, b int")
    assert [r.r for r in df.select(X.result_from_crowns("a", "b").alias("r")).collect()] == ["win", "loss", "draw"]


def test_multiplicity_null_safe(spark):
    df = spark.createDataFrame([(["A", "A", None, "B"],)], "d array<string>")
    r = df.select(X.multiplicity("d", F.lit("A")).alias("a"),
                  X.multiplicity("d", F.lit(None).cast("string")).alias("n")).first()
    assert (r.a, r.n) == (2, 1)


def test_first_or_null_on_empty(spark):
    df = spark.createDataFrame([([],), (None,), ([1, 2],)], "a array<int>")
    assert [r.f for r in df.select(X.first_or_null("a").alias("f")).collect()] == [None, None, 1]


def test_thousands_and_percent_text(spark):
    df = spark.createDataFrame([(1234567, 55.5)], "n int, p double")
    r = df.select(X.thousands("n").alias("t"), X.percent_text("p").alias("q")).first()
    assert (r.t, r.q) == ("1,234,567", "55.5%")


def test_size_for_input(spark):
    from crownlake.session import path_bytes, size_for_input

    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        assert size_for_input(spark, 100 * 1024 ** 4)["spark.sql.shuffle.partitions"] == str(100 * 1024 ** 4 // (128 * 1024 ** 2))
        assert size_for_input(spark, 1024 ** 3)["spark.sql.shuffle.partitions"] == "200"
        assert size_for_input(spark, 16 * 1024 ** 4)["spark.sql.shuffle.partitions"] == str(16 * 1024 ** 4 // (128 * 1024 ** 2))
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(256 * 1024 * 1024)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert path_bytes(spark, "/root/testdata/sf0.001/orders.parquet") > 0
    assert path_bytes(spark, "/nonexistent/path") == 0
