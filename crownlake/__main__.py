"""Command line for spark-submit.

    spark-submit --py-files crownlake.zip crownlake/__main__.py pipeline --root s3a://lake
    python -m crownlake pipeline --root s3a://lake --incremental --day 2024-01-15
    python -m crownlake stream --root s3a://lake

``pipeline`` runs raw -> bronze -> silver -> gold and registers the tables
(prints the row audit). ``stream`` runs one availableNow pass each of the battle
and the profile stream over the raw folder into silver and gold (checkpoints and
rejected battle items under the lake root).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="crownlake")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("pipeline", help="raw -> bronze -> silver -> gold -> catalogue")
    p.add_argument("--root", required=True, help="lake root (shared filesystem or object store URI)")
    p.add_argument("--database", default="match_analytics")
    p.add_argument("--incremental", action="store_true", help="only the given landing days")
    p.add_argument("--day", action="append", default=[], type=dt.date.fromisoformat,
                   help="landing day (YYYY-MM-DD); repeatable")
    p.add_argument("--run-date", type=dt.date.fromisoformat, default=None,
                   help="stamp every row with this ingestion date (the literal run-clock behaviour)")
    p.add_argument("--auto-size", action=argparse.BooleanOptionalAction, default=True,
                   help="size shuffle partitions and scan splits from the bytes under the raw folder (default)")
    p.add_argument("--multi-line", action="store_true", help="raw files each hold one JSON array of records")
    p.add_argument("--last-pull", action="store_true", help="of several pulls of a player on a day read the last one only")
    s = sub.add_parser("stream", help="one availableNow run of the raw streams into silver and gold")
    s.add_argument("--root", required=True)
    s.add_argument("--database", default=None, help="point this database's tables at what the run published")
    args = parser.parse_args(argv)

    from crownlake.plans.pipeline import Lake, run_pipeline
    from crownlake.session import build_session, path_bytes, size_for_input

    spark = build_session()
    if getattr(args, "auto_size", False):
        lake = Lake(args.root)
        size_for_input(spark, path_bytes(spark, lake.raw_battles) + path_bytes(spark, lake.raw_profiles))
    if args.command == "pipeline":
        audit = run_pipeline(spark, args.root, database=args.database, days=args.day or None,
                             incremental=args.incremental, run_date=args.run_date,
                             multi_line=args.multi_line, last_pull=args.last_pull)
        for row in audit.collect():
            print(f"{row.stage}\t{row.rows}")
    else:
        from crownlake.plans.pipeline import path_exists, register_all
        from crownlake.streaming.ingest import BATTLES, PROFILES, run_available_now

        lake, base = Lake(args.root), args.root.rstrip("/")
        feeds = ((BATTLES, lake.raw_battles, lake.silver_battles), (PROFILES, lake.raw_profiles, lake.silver_profiles))
        for feed, raw, silver in feeds:
            if path_exists(spark, raw):
                run_available_now(spark, raw, silver, f"{base}/_checkpoints/{feed.name}", lake=lake, feed=feed,
                                  rejects_path=f"{base}/bronze/_rejects/{feed.name}")
        if args.database:
            register_all(spark, lake, args.database)
    return 0


if __name__ == "__main__":
    sys.exit(main())
