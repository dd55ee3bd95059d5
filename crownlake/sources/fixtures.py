"""Bronze-shaped match data derived from the driver's TPC-H-style tables.

The jobs need battle logs and profile snapshots; the driver ships orders. The
mapping below (orders -> battles, customer-years -> profile snapshots) gives
data whose size grows with the tables, so every job runs over whole tables.

Battle record per order (without line items: empty decks, no elixir, no opponent tag, no crowns):

* player_tag      cleaned ``c_name`` of the ordering customer
* battle_time     ``o_orderdate`` rendered as API text
* battle_type     priority ``1-URGENT`` -> PvP, ``2-HIGH`` -> Ladder, else challenge
* result          status F -> win, O -> loss, P -> draw
* player_trophies ``floor(o_totalprice / 100)``
* player_deck     ``p_type`` of the lines, by (line number, value)
* opponent_deck   ``p_brand`` of the lines, by (line number, value)
* player_elixir_avg  average line quantity
* crowns          count of return flag A (player) / R (opponent)
* opponent_tag    lowest supplier key, as text
* ingestion_date  first day of the order's year (the landing day)
* source_seq      ``o_orderkey`` (landing order inside a day)

Plan shape: lineitem joins part on the part key (shuffle, or a broadcast when
Catalyst's size statistics allow it), the joined lines are shuffled by order
key and reduced per order after the shuffle (an order has a handful of lines,
so the collected arrays are small), and the per-order frame — hash-partitioned
by order key — joins orders without re-shuffling that side. Orders meet their
customers before that, while they are narrow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crownlake.functions import columns as X
from crownlake.sources.tables import read_table

# Fixed mapping values (see module docstring).
PRIORITY_TO_TYPE = (("1-URGENT", "PvP"), ("2-HIGH", "Ladder"))
OTHER_BATTLE_TYPE = "challenge"
STATUS_TO_RESULT = (("F", "win"), ("O", "loss"), ("P", "draw"))
PLAYER_CROWN_FLAG = "A"
OPPONENT_CROWN_FLAG = "R"


def _case(c: F.Column, pairs, default=None) -> F.Column:
    expr = None
    for key, value in pairs:
        expr = (F.when(c == key, F.lit(value)) if expr is None else expr.when(c == key, F.lit(value)))
    return expr.otherwise(F.lit(default))


def _ordered_values(lines: str, value_field: str) -> F.Column:
    """One field of the collected lines, ordered by (line number, value)."""
    pairs = F.arrays_zip(F.col(lines)["k"].alias("k"), F.col(lines)[value_field].alias("v"))
    return F.sort_array(pairs)["v"]


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has line items (decks, elixir, crowns, opponent)."""
    lines = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                       "l_linenumber", "l_quantity", "l_returnflag")
    parts = read_table(spark, sf_dir, "part", "p_partkey", "p_type", "p_brand")
    # Lines are shuffled by order key and aggregated after the shuffle. At
    # scale the part join is a sort-merge join on the part key, which scatters
    # an order's lines over all map partitions, so a map-side partial
    # collect_list would cost CPU without shrinking the shuffle.
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey, "inner").repartition("l_orderkey")
    # One collected buffer per order (line number, type, brand); both decks
    # are cut from it after the aggregate.
    line = F.struct(F.col("l_linenumber").alias("k"), F.col("p_type").alias("t"), F.col("p_brand").alias("b"))
    per_order = joined.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.collect_list(line).alias("_lines"),
        F.avg("l_quantity").alias("player_elixir_avg"),
        X.count_if(F.col("l_returnflag") == PLAYER_CROWN_FLAG).cast("int").alias("crowns_player"),
        X.count_if(F.col("l_returnflag") == OPPONENT_CROWN_FLAG).cast("int").alias("crowns_opponent"),
        F.min("l_suppkey").cast("string").alias("opponent_tag"),
    )
    return per_order.select(
        "o_orderkey",
        _ordered_values("_lines", "t").alias("player_deck"),
        _ordered_values("_lines", "b").alias("opponent_deck"),
        "player_elixir_avg", "crowns_player", "crowns_opponent", "opponent_tag",
    )


def orders_with_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Every order with its lines' values; an order without lines has empty decks and no crowns."""
    joined = orders.join(lines, "o_orderkey", "left")
    empty = F.array().cast("array<string>")
    return joined.withColumns({
        "player_deck": F.coalesce("player_deck", empty),
        "opponent_deck": F.coalesce("opponent_deck", empty),
        "crowns_player": F.coalesce("crowns_player", F.lit(0)),
        "crowns_opponent": F.coalesce("crowns_opponent", F.lit(0)),
    })


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def bronze_battles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat bronze battle records (as the extractor lands them) plus provenance."""
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                        "o_totalprice", "o_orderdate", "o_orderpriority")
    # The player joins the narrow order before the decks do: decks are not shuffled by customer.
    ordered = orders.join(_customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "inner")
    with_player = orders_with_lines(ordered, order_lines(spark, sf_dir))
    return with_player.select(
        X.render_api_time("o_orderdate").alias("battle_time"),
        _case(F.col("o_orderpriority"), PRIORITY_TO_TYPE, OTHER_BATTLE_TYPE).alias("battle_type"),
        _case(F.col("o_orderstatus"), STATUS_TO_RESULT).alias("result"),
        X.clean_tag("c_name").alias("player_tag"),
        F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("player_trophies"),
        "player_deck",
        "player_elixir_avg",
        "crowns_player",
        "crowns_opponent",
        "opponent_tag",
        "opponent_deck",
        F.to_date(F.date_trunc("year", "o_orderdate")).alias("ingestion_date"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ingested_at"),
        F.lit(X.SOURCE_NAME).alias("source"),
        F.lit(X.PIPELINE_VERSION).alias("pipeline_version"),
        F.col("o_orderkey").alias("source_seq"),
    )


def profile_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (customer, order year): the profile counters of that year."""
    orders = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return orders.groupBy(
        "o_custkey", F.to_date(F.date_trunc("year", "o_orderdate")).alias("ingestion_date")
    ).agg(
        F.floor(F.sum("o_totalprice") / 1000).cast("int").alias("trophies"),
        F.floor(F.max("o_totalprice") / 100).cast("int").alias("best_trophies"),
        X.count_if(F.col("o_orderstatus") == "F").cast("int").alias("wins"),
        X.count_if(F.col("o_orderstatus") == "O").cast("int").alias("losses"),
        F.count(F.lit(1)).cast("int").alias("battle_count"),
        F.max("o_orderdate").cast("timestamp_ntz").alias("ingested_at"),
    )


def bronze_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat bronze profile snapshots: one per (customer, order year)."""
    per_year = profile_years(spark, sf_dir)
    joined = per_year.join(_customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "inner")
    return joined.select(
        X.clean_tag("c_name").alias("tag"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("level"),
        "trophies",
        "best_trophies",
        "wins",
        "losses",
        "battle_count",
        F.array().cast("array<struct<id:int,name:string,level:int,max_level:int,rarity:string,"
                       "elixir_cost:int,count:int>>").alias("cards"),
        F.col("c_mktsegment").alias("clan_name"),
        F.col("c_nationkey").cast("string").alias("clan_tag"),
        "ingestion_date",
        "ingested_at",
        F.lit(X.SOURCE_NAME).alias("source"),
        F.lit(X.PIPELINE_VERSION).alias("pipeline_version"),
        F.lit(None).cast("bigint").alias("source_seq"),
    )


def battles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver battles of the table-derived data (the battle-shaped view)."""
    from crownlake.operators.silver import silver_battles

    return silver_battles(bronze_battles(spark, sf_dir))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver profile snapshots of the table-derived data (the profile-shaped view)."""
    from crownlake.operators.silver import silver_profiles

    return silver_profiles(bronze_profiles(spark, sf_dir))
