"""Named queries over the driver's tables: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query builds silver from the tables (``sources.fixtures``) and runs one
job on it. In production silver and gold are materialised once by
``plans.pipeline``; here every query stands alone so it can be checked alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crownlake.functions import columns as X
from crownlake.operators import analytics as A
from crownlake.operators import gold as G
from crownlake.operators import sketches as SK
from crownlake.operators.bronze import normalize_battles, normalize_battles_all, normalize_profiles
from crownlake.operators.coerce import coerce_result, stringify
from crownlake.operators.silver import silver_battles, silver_profiles
from crownlake.operators.streaks import segments
from crownlake.plans import gold_state as GS
from crownlake.schemas import BRONZE_BATTLES, BRONZE_PROFILE, SILVER_BATTLE_COLUMNS
from crownlake.session import lean_disk, scratch_path
from crownlake.sources import fixtures as FX
from crownlake.sources import raw as R
from crownlake.sources import sinks as K
from crownlake.sources.drift import schema_drift
from crownlake.sources.landing import land_pulls
from crownlake.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

# Consecutive keys whose records share one multi-line document: bounds a document, whatever the table.
DOCUMENT_KEYS = 2000
RUN_CLOCK = dt.datetime(2030, 1, 1)


def _battles(spark: SparkSession, sf: str) -> DataFrame:
    return FX.battles(spark, sf)


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return G.fact_battles(FX.battles(spark, sf))


def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    return FX.profiles(spark, sf)


# W4 under its earlier name.
dim_player_by_time = G.dim_player_window


def _items_once(spark: SparkSession, sf: str) -> DataFrame:
    """Raw battle items built from the tables once and stored, for queries that land them in waves."""
    path, items = scratch_path(spark, "items"), R.raw_battle_items(spark, sf)
    K.write_parquet(items, path)
    return spark.read.schema(items.schema).parquet(path)


def q_clean_tag(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer", "c_custkey", "c_name")
    return c.select("c_custkey", "c_name", X.clean_tag("c_name").alias("player_tag"))


def q_deck_with_cards_literal(spark: SparkSession, sf: str) -> DataFrame:
    b = _battles(spark, sf)
    return A.deck_with_cards(G.fact_battles(b), b, literal=True)


def q_deck_with_cards_repaired(spark: SparkSession, sf: str) -> DataFrame:
    b = _battles(spark, sf)
    return A.deck_with_cards(G.fact_battles(b), b, literal=False)


def q_parse_deck(spark: SparkSession, sf: str) -> DataFrame:
    """decks rendered as result text and parsed back."""
    b = _battles(spark, sf).select("battle_id", X.render_deck("player_deck").alias("deck_text"))
    return b.select("battle_id", "deck_text", X.parse_deck("deck_text").alias("deck_cards"))


def q_coerce_result(spark: SparkSession, sf: str) -> DataFrame:
    """A gold table paged back as text, then typed again."""
    text = stringify(G.card_usage(_battles(spark, sf)))
    return coerce_result(text, {"usage_count": "number", "win_rate": "number"})


def q_bronze_battles(spark: SparkSession, sf: str) -> DataFrame:
    """C2 on landed raw JSON: render API items from the tables, land, read, normalise."""
    path = scratch_path(spark, "raw-battles")
    R.land_json(R.raw_battle_items(spark, sf), path)
    kept, _rejects = normalize_battles(R.read_raw_battles(spark, path))
    return kept.select(*BRONZE_BATTLES.names, "ingestion_date")


def q_bronze_battles_text(spark: SparkSession, sf: str) -> DataFrame:
    """C2 on payloads landed as JSON text lines (``to_json`` out, ``from_json`` in)."""
    path = scratch_path(spark, "raw-battles-text")
    R.land_json_text(R.raw_battle_items(spark, sf), path)
    kept, _rejects = normalize_battles(R.read_raw_battles_text(spark, path))
    return kept.select(*BRONZE_BATTLES.names, "ingestion_date")


def q_bronze_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """C1 on landed raw JSON."""
    path = scratch_path(spark, "raw-profiles")
    R.land_json(R.raw_profiles(spark, sf), path)
    return normalize_profiles(R.read_raw_profiles(spark, path)).select(*BRONZE_PROFILE.names, "ingestion_date")


def q_landing_last_pull(spark: SparkSession, sf: str) -> DataFrame:
    """One log per nation and year; even nations were pulled again, when their log held only the year's second half.

    The second pull replaces the first one of the same tag and day.
    """
    base = scratch_path(spark, "pulls")
    nations = read_table(spark, sf, "customer", "c_custkey", "c_nationkey").withColumnRenamed("c_custkey", "n_custkey")
    keys = ["o_orderdate", "c_nationkey"]
    built = R.raw_battle_items(spark, sf, keys=tuple(keys), also=lambda o: o.join(nations, F.col("o_custkey") == F.col("n_custkey")))
    # Both pulls are read from one stored copy.
    built.write.parquet(f"{base}-items")
    items = spark.read.schema(built.schema).parquet(f"{base}-items").withColumn("player_tag", F.concat(F.lit("N"), "c_nationkey"))
    land_pulls(items.drop(*keys), base, "06-00")
    again = (F.col("c_nationkey") % 2 == 0) & (F.month("o_orderdate") >= 7)
    land_pulls(items.where(again).drop(*keys), base, "18-00")
    kept, _rejects = normalize_battles(R.read_raw_battles(spark, base, last_pull=True))
    return kept.select(*BRONZE_BATTLES.names, "ingestion_date")


def _broken_items(spark: SparkSession, sf: str) -> DataFrame:
    """Raw battle items, those of some priorities and states without their time, team or opponent."""
    items = R.raw_battle_items(spark, sf, keys=("o_orderkey",)).join(
        read_table(spark, sf, "orders", "o_orderkey", "o_orderstatus"), "o_orderkey")
    none = F.array()
    return items.withColumns({
        "battleTime": F.when(F.col("type") != "PvP", F.col("battleTime")),
        "team": F.when(F.col("type") == "Ladder", none).otherwise(F.col("team")),
        "opponent": F.when(F.col("o_orderstatus") == "P", none).otherwise(F.col("opponent")),
    }).drop("o_orderkey", "o_orderstatus")


def q_battle_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Items that lack their time, team or opponent, by reject reason (NULL: kept)."""
    reasons = normalize_battles_all(_broken_items(spark, sf)).groupBy("reject_reason")
    return reasons.agg(F.count(F.lit(1)).alias("items"))


def q_stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The same broken items through the stream; what it set aside, by reason."""
    from crownlake.streaming.ingest import run_available_now

    base = scratch_path(spark, "stream-rejects")
    R.land_json(_broken_items(spark, sf), f"{base}/raw")
    run_available_now(spark, f"{base}/raw", f"{base}/silver", f"{base}/checkpoint", rejects_path=f"{base}/rejects")
    return spark.read.parquet(f"{base}/rejects").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("items"))


def q_coerce_bad_text(spark: SparkSession, sf: str) -> DataFrame:
    """Text with bad dates, bad numbers and missing values; rows that lack any value go."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    text = o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(urgent, "n/a").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("day"),
        F.when(F.col("o_orderstatus") == "P", "bad").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(~high, F.col("o_orderpriority")).alias("priority"),
    )
    return coerce_result(text, {"day": "date", "price": "number"}, order_by=["day", "id"])


def q_battle_type_texts(spark: SparkSession, sf: str) -> DataFrame:
    """totals with thousands separators and rates as percent text."""
    g = _battles(spark, sf).groupBy("battle_type").agg(
        F.sum("player_trophies").alias("total"), F.count(F.lit(1)).alias("n"), X.count_if(X.is_win()).alias("w"))
    return g.select("battle_type", X.thousands("total").alias("trophies_text"),
                    X.percent_text(X.pct("w", "n")).alias("win_text"))


def q_bronze_multiline_battles(spark: SparkSession, sf: str) -> DataFrame:
    """Flat bronze in files of one indented array each, read and built into silver."""
    path = scratch_path(spark, "multiline-battles")
    R.land_json_documents(FX.bronze_battles(spark, sf), path, F.floor(F.col("source_seq") / DOCUMENT_KEYS))
    return silver_battles(R.read_bronze(spark, path, R.BRONZE_BATTLES_LANDED, multi_line=True, pattern="*.txt"))


def q_bronze_multiline_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """As above, of profiles."""
    path = scratch_path(spark, "multiline-profiles")
    number = F.regexp_extract("name", r"(\d+)$", 1).cast("bigint")
    R.land_json_documents(FX.bronze_profiles(spark, sf), path, F.floor(number / DOCUMENT_KEYS))
    return silver_profiles(R.read_bronze(spark, path, R.BRONZE_PROFILE_LANDED, multi_line=True, pattern="*.txt"))


def q_stream_ingest_available_now(spark: SparkSession, sf: str) -> DataFrame:
    """Two landing waves, each picked up by an availableNow stream run."""
    from crownlake.streaming.ingest import run_available_now

    base = scratch_path(spark, "stream")
    raw, silver, ckpt = f"{base}/raw", f"{base}/silver", f"{base}/checkpoint"
    items = _items_once(spark, sf)
    split = items.agg(F.percentile_approx(F.unix_date("ingestion_date"), 0.5).alias("d")).first()["d"]
    first_wave = F.unix_date("ingestion_date") <= F.lit(split)
    R.land_json(items.where(first_wave), raw, mode="append", few_days=True)
    run_available_now(spark, raw, silver, ckpt)
    R.land_json(items.where(~first_wave), raw, mode="append", few_days=True)
    run_available_now(spark, raw, silver, ckpt)
    return spark.read.parquet(silver)


def q_stream_profiles_available_now(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles in two landing waves, the second with the first once more, each picked up by an availableNow run."""
    from crownlake.streaming.ingest import PROFILES, run_available_now

    base = scratch_path(spark, "stream-profiles")
    raw, silver, ckpt = f"{base}/raw", f"{base}/silver", f"{base}/checkpoint"
    profiles = R.raw_profiles(spark, sf)
    for wave in (profiles.where("expLevel < 12"), profiles):
        R.land_json(wave, raw, mode="append")
        run_available_now(spark, raw, silver, ckpt, feed=PROFILES)
    return spark.read.parquet(silver)


def q_stream_dedup_late(spark: SparkSession, sf: str) -> DataFrame:
    """R2: the newer half lands and is streamed first, then the older half: no battle is lost or doubled."""
    from crownlake.streaming.ingest import run_available_now

    base = scratch_path(spark, "stream-late")
    raw, silver, ckpt = f"{base}/raw", f"{base}/silver", f"{base}/checkpoint"
    items = _items_once(spark, sf)
    split = items.agg(F.percentile_approx(F.unix_date("ingestion_date"), 0.5).alias("d")).first()["d"]
    newer = F.unix_date("ingestion_date") > F.lit(split)
    for wave in (newer, ~newer):
        R.land_json(items.where(wave), raw, mode="append", few_days=True)
        run_available_now(spark, raw, silver, ckpt)
    return spark.read.parquet(silver).select(*SILVER_BATTLE_COLUMNS)


def q_stream_watermark_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """R2: the newer half, then its last year once more with the year before the half, then everything again: state and late lane."""
    from crownlake.streaming.dedup import run_deduplicated

    base = scratch_path(spark, "stream-watermark")
    raw, silver, ckpt = f"{base}/raw", f"{base}/silver", f"{base}/checkpoint"
    items = _items_once(spark, sf)
    day = F.unix_date("ingestion_date")
    split, last = items.agg(F.percentile_approx(day, 0.5).alias("d"), F.max(day).alias("m")).first()
    for wave in (day > split, (day == last) | (day == split), F.lit(True)):
        R.land_json(items.where(wave), raw, mode="append", few_days=True)
        run_deduplicated(spark, raw, silver, ckpt, delay="400 days")
    return spark.read.parquet(silver).select(*SILVER_BATTLE_COLUMNS)


def q_pipeline_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """All days but the last in a full run, the last one twice as an incremental run; all published gold tables."""
    from crownlake.plans import publish
    from crownlake.plans.pipeline import Lake, read_gold, run_pipeline

    lake, later = Lake(scratch_path(spark, "lake")), scratch_path(spark, "last-day")
    with lean_disk(spark):
        items = _items_once(spark, sf)
        last = items.agg(F.max("ingestion_date").alias("d")).first()["d"]
        R.land_json(items.where(F.col("ingestion_date") < last), lake.raw_battles, few_days=True)
        # The other days are landed: only the last one's items are kept until it is.
        K.write_parquet(items.where(F.col("ingestion_date") == last), later)
    with lean_disk(spark):
        R.land_json(R.raw_profiles(spark, sf), lake.raw_profiles, few_days=True)
        database = "crownlake_" + lake.root.rsplit("-", 1)[-1]
        run_pipeline(spark, lake.root, database)
        R.land_json(spark.read.schema(items.schema).parquet(later), lake.raw_battles, mode="append", few_days=True)
        K.remove_folder(spark, later)
        for _ in range(2):
            run_pipeline(spark, lake.root, database, days=[last], incremental=True)
    version = publish.current(spark, lake.curated)
    tables = [read_gold(spark, lake, n, version).select(F.lit(n).alias("table"), "*") for n in G.GOLD_TABLE_NAMES]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def q_player_streaks_stored(spark: SparkSession, sf: str) -> DataFrame:
    """W5/C15/C24 as stored state: segments of the newer days, then of the older ones, joined to streaks of all players."""
    path, fact_path = scratch_path(spark, "segments"), scratch_path(spark, "fact-battles")
    K.write_parquet(_fact(spark, sf), fact_path, ["ingestion_date"], partition_overwrite="static")
    fact = spark.read.parquet(fact_path)
    day = F.unix_date("ingestion_date")
    split = fact.agg(F.percentile_approx(day, 0.5).alias("d")).first()["d"]
    for part in (day > split, day <= split):
        K.write_parquet(segments(fact.where(part), "ingestion_date"), path, ["ingestion_date"], "append")
    return GS.player_streaks(spark.read.parquet(path), fact)


def q_players_to_date(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct players up to each day, exactly; ``close``: the union of the days' sketches is within three deviations."""
    path = scratch_path(spark, "sketches")
    profiles = _profiles(spark, sf)
    K.write_parquet(SK.player_sketches(profiles), path, ["ingestion_date"], partition_overwrite="static")
    both = SK.exact_players_to_date(profiles).join(SK.players_to_date(spark.read.parquet(path)), "ingestion_date")
    off = F.abs(F.col("estimate") - F.col("players"))
    return both.select("ingestion_date", "players", (off <= 3 * SK.DEVIATION * F.col("players")).alias("close"))


def q_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """In the last year's landing a field is new, one has gone, and the crowns came as text."""
    path = scratch_path(spark, "drifted")
    items = _items_once(spark, sf)
    last = items.agg(F.max("ingestion_date").alias("d")).first()["d"]
    R.land_json(items.where(F.col("ingestion_date") < last), path, few_days=True)
    as_text = F.transform("team", lambda t: t.withField("crowns", t["crowns"].cast("string")))
    drifted = items.where(F.col("ingestion_date") == last).withColumns({"team": as_text, "arena": F.struct(F.lit(1).alias("id"))})
    R.land_json(drifted.drop("type"), path, mode="append", few_days=True)
    return schema_drift(spark, path, R.RAW_BATTLE_LANDED)


def q_sorted_write(spark: SparkSession, sf: str) -> DataFrame:
    """The weekly trophies written sorted and read back, each row checked against the order of rows and files."""
    path = scratch_path(spark, "sorted")
    by = ["player_tag", "week"]
    K.write_sorted(G.trophy_evolution(_battles(spark, sf)), path, by)
    return K.checked_order(spark, path, by)


def q_partition_sync(spark: SparkSession, sf: str) -> DataFrame:
    """A registered table after its first day's folder was removed and its last day's was added."""
    path = scratch_path(spark, "fact-days")
    # Built once: the two writes below take their days from the stored copy.
    built = _fact(spark, sf)
    K.write_parquet(built, f"{path}-built", ["ingestion_date"], partition_overwrite="static")
    fact = spark.read.schema(built.schema).parquet(f"{path}-built")
    first, last = fact.agg(F.min("ingestion_date"), F.max("ingestion_date")).first()
    K.write_parquet(fact.where(F.col("ingestion_date") < F.lit(last)), path, ["ingestion_date"], partition_overwrite="static")
    name = "fact_days_" + path.rstrip("/").rsplit("-", 1)[-1]
    table = K.register_table(spark, "crownlake_check", name, path, K.ddl_of(spark.read.parquet(path)), ["ingestion_date"])
    K.sync_partitions(spark, table, path)
    K.write_parquet(fact.where(F.col("ingestion_date") == F.lit(last)), path, ["ingestion_date"], "append")
    K.remove_folder(spark, f"{path}/ingestion_date={first}")
    K.sync_partitions(spark, table, path)
    return spark.table(table)


def q_databases(spark: SparkSession, sf: str) -> DataFrame:
    """A database per region, listed."""
    regions = read_table(spark, sf, "region", "r_name")
    for row in regions.select(F.lower("r_name").alias("n")).collect():  # a handful of regions
        K.ensure_database(spark, f"crownlake_region_{row.n}".replace(" ", "_"))
    return spark.sql("SHOW DATABASES LIKE 'crownlake_region_*'").select(F.col("namespace").alias("database"))


def q_parquet_roundtrip_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Silver written partitioned by ingestion_date and read back."""
    path = scratch_path(spark, "silver-battles")
    K.write_parquet(_battles(spark, sf), path, ["ingestion_date"], partition_overwrite="static")
    return spark.read.parquet(path)


def q_table_register_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Fact written partitioned, registered over its folder, repaired, read by name."""
    path = scratch_path(spark, "fact-battles")
    fact = _fact(spark, sf)
    K.write_parquet(fact, path, ["ingestion_date"], partition_overwrite="static")
    name = "fact_battles_" + path.rstrip("/").rsplit("-", 1)[-1]
    q = K.register_table(spark, "crownlake_check", name, path, K.ddl_of(spark.read.parquet(path)),
                         ["ingestion_date"])
    K.repair_table(spark, q)
    return spark.table(q)


def q_row_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Silver and gold built and written from bronze, rows counted on the writes."""
    from crownlake.plans.pipeline import build_from_bronze

    root = scratch_path(spark, "lake")
    return build_from_bronze(spark, root, FX.bronze_battles(spark, sf), FX.bronze_profiles(spark, sf))


def core_queries() -> dict[str, Query]:
    return {
        # silver (C3, C4)
        "silver_battles": _battles,
        "silver_profiles": _profiles,
        "clean_tag": q_clean_tag,
        # the run's clock instead of the landing's
        "silver_battles_run_date": lambda s, sf: silver_battles(FX.bronze_battles(s, sf), run_date=RUN_CLOCK.date()),
        "silver_profiles_run_time": lambda s, sf: silver_profiles(FX.bronze_profiles(s, sf), run_ts=RUN_CLOCK),
        # gold (C5-C12)
        "dim_player": lambda s, sf: G.dim_player(_profiles(s, sf)),
        "dim_player_window": lambda s, sf: G.dim_player_window(_profiles(s, sf)),
        "dim_card": lambda s, sf: G.dim_card(_battles(s, sf)),
        "dim_card_union": lambda s, sf: G.dim_card_union(_battles(s, sf)),
        "dim_deck": lambda s, sf: G.dim_deck(_battles(s, sf)),
        "fact_battles": _fact,
        "win_rate_by_card": lambda s, sf: G.win_rate_by_card(_battles(s, sf)),
        "card_usage": lambda s, sf: G.card_usage(_battles(s, sf)),
        "win_rate_by_deck": lambda s, sf: G.win_rate_by_deck(_battles(s, sf)),
        # threshold 1: the values the original threshold (5) filters out at small scale
        "win_rate_by_deck_any": lambda s, sf: G.win_rate_by_deck(_battles(s, sf), min_battles=1),
        "trophy_steps": lambda s, sf: G.trophy_steps(G.trophy_evolution(_battles(s, sf))),
        "win_rate_by_deck_two": lambda s, sf: G.win_rate_by_deck(_battles(s, sf), min_battles=2),
        "trophy_evolution": lambda s, sf: G.trophy_evolution(_battles(s, sf)),
        # saved analytics
        "deck_leaderboard": lambda s, sf: A.deck_leaderboard(_fact(s, sf)),
        "card_leaderboard": lambda s, sf: A.card_leaderboard(_battles(s, sf)),
        "streak_leaderboard": lambda s, sf: A.streak_leaderboard(_fact(s, sf)),
        "elixir_by_outcome": lambda s, sf: A.elixir_by_outcome(_battles(s, sf)),
        "trophies_by_date": lambda s, sf: A.trophies_by_date(_profiles(s, sf)),
        # dashboard analytics
        "latest_profile": lambda s, sf: A.latest_profile(_profiles(s, sf)),
        "trophies_by_date_asc": lambda s, sf: A.trophies_by_date_asc(_profiles(s, sf)),
        "top_cards": lambda s, sf: A.top_cards(_battles(s, sf)),
        "card_win_rate_all": lambda s, sf: A.card_win_rate_all(_battles(s, sf)),
        "deck_with_cards_literal": q_deck_with_cards_literal,
        "deck_with_cards_repaired": q_deck_with_cards_repaired,
        "elixir_by_outcome_simple": lambda s, sf: A.elixir_by_outcome_simple(_battles(s, sf)),
        "longest_streaks": lambda s, sf: A.longest_streaks(_fact(s, sf)),
        # the same two with coarser buckets, and with one window per player
        "streak_leaderboard_split": lambda s, sf: A.streak_leaderboard(_fact(s, sf), units=("day", "month")),
        "longest_streaks_split": lambda s, sf: A.longest_streaks(_fact(s, sf), units=("day", "month")),
        "streak_leaderboard_literal": lambda s, sf: A.streak_leaderboard(_fact(s, sf), units=()),
        "outcome_split": lambda s, sf: A.outcome_split(_profiles(s, sf)),
    }


def io_queries() -> dict[str, Query]:
    return {
        "parse_deck": q_parse_deck,
        "coerce_result": q_coerce_result,
        "coerce_bad_text": q_coerce_bad_text,
        "battle_type_texts": q_battle_type_texts,
        "battle_rejects": q_battle_rejects,
        "bronze_multiline_battles": q_bronze_multiline_battles,
        "bronze_multiline_profiles": q_bronze_multiline_profiles,
        "bronze_battles": q_bronze_battles,
        "landing_last_pull": q_landing_last_pull,
        "bronze_battles_text": q_bronze_battles_text,
        "bronze_profiles": q_bronze_profiles,
        "stream_ingest_available_now": q_stream_ingest_available_now,
        "stream_dedup_late": q_stream_dedup_late,
        "stream_watermark_dedup": q_stream_watermark_dedup,
        "stream_profiles_available_now": q_stream_profiles_available_now,
        "stream_rejects": q_stream_rejects,
        "pipeline_incremental": q_pipeline_incremental,
        "parquet_roundtrip_partitioned": q_parquet_roundtrip_partitioned,
        "table_register_repair": q_table_register_repair,
        "row_audit": q_row_audit,
        "player_streaks_stored": q_player_streaks_stored,
        "players_to_date": q_players_to_date,
        "schema_drift": q_schema_drift,
        "sorted_write": q_sorted_write,
        "partition_sync": q_partition_sync,
        "databases": q_databases,
    }


def all_queries() -> dict[str, Query]:
    return {**core_queries(), **io_queries()}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The headline query: the deck leaderboard over the fact table."""
    return A.deck_leaderboard(_fact(spark, sf))

