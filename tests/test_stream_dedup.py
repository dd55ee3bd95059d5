"""R2: repeats dropped by state under a watermark, late rows merged."""

import datetime as dt

from pyspark.sql import functions as F

from crownlake.sources import raw as R
from crownlake.streaming.dedup import battle_rows, run_deduplicated

from test_landing import item


def land(spark, base, name, battles, day="2024-06-01"):
    """``battles``: (tag, day number of the battle, crowns)."""
    import json
    import os

    folder = f"{base}/raw/ingestion_date={day}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        for tag, number, crowns in battles:
            time = (dt.datetime(2024, 1, 1) + dt.timedelta(days=number)).strftime("%Y%m%dT%H%M%S.000Z")
            record = item(time) | {"player_tag": tag}
            record["team"] = [dict(record["team"][0], crowns=crowns)]
            f.write(json.dumps(record) + "\n")


def test_repeats_state_and_late_rows(spark, tmp_dir):
    base, silver = f"{tmp_dir}/lake", f"{tmp_dir}/silver"

    def run():
        return run_deduplicated(spark, f"{base}/raw", silver, f"{tmp_dir}/ckpt", delay="10 days")

    def stored():
        return sorted((r.player_tag, r.battle_time.strftime("%j"), r.crowns_player) for r in spark.read.parquet(silver).collect())

    first = [("A", n, 1) for n in range(100, 140)]
    land(spark, base, "one", first + first[-5:])
    assert run().late_rows == 0
    # Repeats, new battles, and a different record of a stored battle: the first landing wins.
    land(spark, base, "two", first[-8:] + [("A", n, 1) for n in range(140, 160)] + [("A", 139, 3)])
    second = run()
    assert second.late_rows == 0 and second.watermark is not None
    # History that lands after the watermark has passed it, once more with a repeat.
    late = [("B", n, 2) for n in range(20)]
    land(spark, base, "three", late + late[:3] + [("A", 100, 3), ("A", 161, 1)])
    third = run()
    assert third.late_rows > 0
    want = [("A", n, 1) for n in [*range(100, 160), 161]] + late
    assert stored() == sorted((t, f"{n + 1:03d}", c) for t, n, c in want)
    # State holds the battles near the watermark only, not the 80 stored ones.
    assert third.state_rows <= 30
    # Nothing landed: nothing changes.
    assert run().rows_in == 0 and len(stored()) == len(want)


def test_a_run_that_stopped_between_the_lanes(spark, tmp_dir, monkeypatch):
    """The late lane of the next run still has the files, and no row is lost."""
    from crownlake.streaming import dedup

    base, silver = f"{tmp_dir}/lake", f"{tmp_dir}/silver"
    land(spark, base, "one", [("A", n, 1) for n in range(100, 120)])
    run_deduplicated(spark, f"{base}/raw", silver, f"{tmp_dir}/ckpt", delay="5 days")
    land(spark, base, "two", [("A", n, 1) for n in range(10)])
    real, calls = dedup._finished, []

    def stops(query):
        calls.append(query)
        if len(calls) == 2:
            query.stop()
            raise RuntimeError("lost driver")
        return real(query)

    monkeypatch.setattr(dedup, "_finished", stops)
    try:
        run_deduplicated(spark, f"{base}/raw", silver, f"{tmp_dir}/ckpt", delay="5 days")
    except RuntimeError:
        pass
    monkeypatch.setattr(dedup, "_finished", real)
    run_deduplicated(spark, f"{base}/raw", silver, f"{tmp_dir}/ckpt", delay="5 days")
    assert spark.read.parquet(silver).count() == 30


def test_stream_rows_equal_the_batch_job(spark, tmp_dir):
    """Both lanes together give the silver rows of the batch job, all columns."""
    from crownlake.operators.dedup import keep_first
    from crownlake.schemas import SILVER_BATTLE_COLUMNS

    base, silver = f"{tmp_dir}/lake", f"{tmp_dir}/silver"
    for wave, numbers in enumerate((range(60, 90), range(0, 90, 2), range(0, 90, 3))):
        land(spark, base, f"wave{wave}", [("AB"[n % 2], n, 1) for n in numbers])
        run_deduplicated(spark, f"{base}/raw", silver, f"{tmp_dir}/ckpt", delay="7 days", max_files_per_trigger=1)
    rows = battle_rows(R.read_raw_battles(spark, f"{base}/raw"))
    want = keep_first(rows, ["battle_id"], ["ingestion_date", "_source_seq"]).select(*SILVER_BATTLE_COLUMNS)
    got = spark.read.parquet(silver).select(*SILVER_BATTLE_COLUMNS)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.agg(F.count_distinct("battle_id").alias("n")).first().n == got.count()
