"""Benchmark: prints ONE JSON line with per-query seconds.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query is forced in full with the ``noop`` sink (no driver collect).
Sections:

* ``<name>``          each registered query, end to end from the parquet tables
                      (builds silver from orders/lines/parts/customers first);
* ``pipeline_build``  silver + all gold tables written once (``build_from_bronze``);
* ``stored_<name>``   analytics over the stored silver/fact tables — the way the
                      dashboard and saved queries run — with the default plans.

``value`` is the sum of those. ``io`` (not summed) times the queries that land,
stream, write or register on their way. ``pipeline`` (not summed) times a full run from
landed raw JSON and the incremental run of one more landing day. ``baselines`` (not summed) times the literal or
alternative forms over the same stored tables: fan-out join vs eager
aggregation, per-player window vs hot-key split streaks, distinct vs
distinct-free card counts, window vs aggregate latest-per-player.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from crownlake.session import build_session, scratch_path

    scratch = tempfile.mkdtemp(prefix="crownlake-bench-")
    spark = build_session(
        f"local[{cpus}]",
        app_name="crownlake-bench",
        shuffle_partitions=max(8, cpus * 2),
        extra={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    from crownlake.operators import analytics as A
    from crownlake.operators import gold as G
    from crownlake.plans import registry
    from crownlake.plans.pipeline import PLAYER_STREAKS, Lake, build_from_bronze, read_gold
    from crownlake.sources import fixtures as FX

    def run(df) -> float:
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    # Warm-up (JVM, codegen caches); not timed.
    run(registry.flagship(spark, sf_dir))

    times: dict[str, float] = {}
    for name, fn in registry.core_queries().items():
        times[name] = run(fn(spark, sf_dir))
    # Queries that write and stream do so while they build their result: timed from the call on.
    # Two whole-pipeline queries are left to ``pipeline_build`` and ``pipeline`` below.
    io = {}
    for name, fn in registry.io_queries().items():
        if name in ("row_audit", "pipeline_incremental"):
            continue
        t0 = time.perf_counter()
        run(fn(spark, sf_dir))
        io[name] = round(time.perf_counter() - t0, 3)

    # Scratch tables go under the session's shared checkpoint folder.
    lake_root = scratch_path(spark, "bench-lake")
    t0 = time.perf_counter()
    build_from_bronze(spark, lake_root, FX.bronze_battles(spark, sf_dir), FX.bronze_profiles(spark, sf_dir))
    times["pipeline_build"] = round(time.perf_counter() - t0, 3)

    lake = Lake(lake_root)
    silver = spark.read.parquet(lake.silver_battles)
    fact = read_gold(spark, lake, "fact_battles")
    profiles = spark.read.parquet(lake.silver_profiles)
    # Default plans over the stored tables (what the saved queries and the
    # dashboard run).
    stored = {
        "deck_leaderboard": A.deck_leaderboard(fact),
        "card_leaderboard": A.card_leaderboard(silver),
        "streak_leaderboard": A.top_streaks(read_gold(spark, lake, PLAYER_STREAKS)),
        "longest_streaks": A.longest_of(read_gold(spark, lake, PLAYER_STREAKS)),
        "dim_player": G.dim_player(profiles),
        "deck_with_cards": A.deck_with_cards(fact, silver, literal=True),
        "elixir_by_outcome": A.elixir_by_outcome(silver),
        "trophies_by_date": A.trophies_by_date(profiles),
        "top_cards": A.top_cards(silver),
    }
    for name, df in stored.items():
        times[f"stored_{name}"] = run(df)

    # Literal / alternative forms, for comparison only (not in the total).
    alternatives = {
        "card_leaderboard_distinct": A.card_leaderboard(silver, unique_battles=False),
        "streak_leaderboard_from_fact": A.streak_leaderboard(fact),
        "streak_leaderboard_window": A.streak_leaderboard(fact, units=()),
        "dim_player_window": G.dim_player_window(profiles),
    }
    baselines = {f"stored_{name}": run(df) for name, df in alternatives.items()}

    # Raw JSON -> bronze -> silver -> state/gold -> catalogue, full run on all
    # but the last landing day, then the incremental run of that day (not summed).
    from pyspark.sql import functions as F

    from crownlake.plans.pipeline import run_pipeline
    from crownlake.sources import raw as R

    items, profs = R.raw_battle_items(spark, sf_dir), R.raw_profiles(spark, sf_dir)
    last = items.agg(F.max("ingestion_date")).first()[0]
    inc = Lake(scratch_path(spark, "bench-incremental"))
    R.land_json(items.where(F.col("ingestion_date") < last), inc.raw_battles)
    R.land_json(profs.where(F.col("ingestion_date") < last), inc.raw_profiles)
    pipeline = {}
    t0 = time.perf_counter()
    run_pipeline(spark, inc.root, database="bench_lake")
    pipeline["full_from_raw"] = round(time.perf_counter() - t0, 3)
    R.land_json(items.where(F.col("ingestion_date") == last), inc.raw_battles, mode="append")
    R.land_json(profs.where(F.col("ingestion_date") == last), inc.raw_profiles, mode="append")
    t0 = time.perf_counter()
    run_pipeline(spark, inc.root, database="bench_lake", days=[last], incremental=True)
    pipeline["incremental_one_day"] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "io": io, "baselines": baselines, "pipeline": pipeline,
                      "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
