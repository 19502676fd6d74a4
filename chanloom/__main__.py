"""Command line: ``python -m chanloom build --landing DIR --sources FILE ...``.

Runs the end-to-end build on the active Spark master (``spark-submit`` or a
local session for small runs)."""

from __future__ import annotations

import argparse
import json


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="chanloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build playlists, catalogue and reports")
    b.add_argument("--landing", required=True, help="folder of <source>.m3u playlist files")
    b.add_argument("--sources", required=True, help="source registry JSON")
    b.add_argument("--profile", default=None, help="profile JSON (limits, tiers, rules)")
    b.add_argument("--overrides", default=None, help="overrides JSON")
    b.add_argument("--samples", default=None, help="captured HTTP samples (Parquet)")
    b.add_argument("--manifest", default=None, help="folder of the log of landed files, kept from build to build")
    b.add_argument("--output", required=True, help="output folder (versions; the last commit is live)")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from .plans.job import run_build
    from .session import get_spark

    spark = SparkSession.getActiveSession() or get_spark()
    res = run_build(spark, args.landing, args.sources, args.profile, args.overrides, args.samples,
                    args.output, manifest_dir=args.manifest)
    print(json.dumps({r["stat"]: r["value"] for r in res.stats.collect()}, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
