"""Command-line jobs (the batch and incremental entry points).

    python -m tripspark.cli raw-to-curated --raw R --curated C [--rejects Q] [--profile]
                                           [--licenses L] [--cbd-column NAME] [--no-rebalance]
    python -m tripspark.cli curated-to-aggregated --curated C --zones Z --out O
    python -m tripspark.cli incremental --raw R --zones Z --out O [--max-files-per-trigger N]
                                           [--cbd-column NAME] [--checkpoint D] [--rebuild | --compact]
    python -m tripspark.cli landing --raw R --mode historical|current [--as-of YYYY-MM-DD]
                                    [--base-year 2024] [--strict-reference] --marker M [--source S]

Paths are parameters (any Hadoop-compatible URI). Each job prints one JSON
line with its counts. The stream checkpoint of ``incremental`` lives under
``spark.checkpoint.dir`` unless ``--checkpoint`` is given.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import hashlib
import json

from pyspark.sql import functions as F

from tripspark.operators import landing
from tripspark.plans.pipelines import curated_to_aggregated, raw_to_curated
from tripspark.session import build_session, same_path
from tripspark.sinks.ledger import duplicate_files_skipped, land_files
from tripspark.streaming.incremental import IncrementalPipeline

TOP_LICENSES = 100


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="tripspark")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="job", required=True)
    a = sub.add_parser("raw-to-curated")
    a.add_argument("--raw", required=True)
    a.add_argument("--curated", required=True)
    a.add_argument("--rejects", default=None, help="also write rejected rows with their failed rules here")
    a.add_argument("--profile", action="store_true", help="add raw NULL counts and license distribution")
    a.add_argument("--licenses", default=None, help="with --profile: write the whole license distribution here")
    a.add_argument("--cbd-column", default=None, help="raw column with the congestion fee")
    a.add_argument("--no-rebalance", action="store_true", help="write without the shuffle that evens out files")
    b = sub.add_parser("curated-to-aggregated")
    b.add_argument("--curated", required=True)
    b.add_argument("--zones", required=True)
    b.add_argument("--out", required=True)
    c = sub.add_parser("incremental")
    c.add_argument("--raw", required=True)
    c.add_argument("--zones", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--checkpoint", default=None)
    c.add_argument("--max-files-per-trigger", type=int, default=None)
    c.add_argument("--cbd-column", default=None)
    e = c.add_mutually_exclusive_group()
    e.add_argument("--rebuild", action="store_true", help="drop tables and checkpoint, process everything")
    e.add_argument("--compact", action="store_true", help="merge the batches' folders after the run")
    d = sub.add_parser("landing")
    d.add_argument("--raw", required=True)
    d.add_argument("--mode", choices=["historical", "current"], default="historical")
    d.add_argument("--as-of", default=None)
    d.add_argument("--base-year", type=int, default=landing.DEFAULT_BASE_YEAR)
    d.add_argument("--strict-reference", action="store_true")
    d.add_argument("--marker", required=True, help="folder of the marker ingestion.done")
    d.add_argument("--job-run-id", default="unknown")
    d.add_argument("--source", default=None, help="first land this folder's monthly files, skipping those in the ledger")
    args = ap.parse_args(argv)

    spark = build_session(master=args.master, shuffle_partitions=None)
    if args.job == "raw-to-curated":
        out = raw_to_curated(spark, args.raw, args.curated, rejects_path=args.rejects, profile=args.profile,
                             cbd_column=args.cbd_column, rebalance=not args.no_rebalance)
        if "licenses" in out and args.licenses:
            out["licenses"].write.mode("overwrite").parquet(args.licenses)
        if "licenses" in out:  # any number of dirty values: the job prints the most frequent ones
            out["licenses"] = {r["hvfhs_license_num"]: r["count"] for r in out["licenses"].limit(TOP_LICENSES).collect()}
    elif args.job == "curated-to-aggregated":
        out = curated_to_aggregated(spark, args.curated, args.zones, args.out, count_overflows=True)
    elif args.job == "incremental":
        # stable per output folder: the checkpoint is the bookmark between runs
        key = hashlib.sha1(same_path(spark, args.out).encode()).hexdigest()[:16]
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not args.checkpoint and not shared:
            ap.error("incremental needs --checkpoint or spark.checkpoint.dir")
        ckpt = args.checkpoint or f"{shared}/tripspark-stream-{key}"
        pipe = IncrementalPipeline(spark, args.raw, args.zones, args.out, ckpt,
                                   max_files_per_trigger=args.max_files_per_trigger, cbd_column=args.cbd_column)
        out = {"batches": pipe.rebuild() if args.rebuild else pipe.run()}
        if args.compact:
            out["folders"] = pipe.compact()
    else:
        as_of = _dt.date.fromisoformat(args.as_of) if args.as_of else None
        skipped = duplicate_files_skipped(land_files(spark, args.source, args.raw)) if args.source else 0
        landed = landing.landed_periods(spark, args.raw)
        latest = landing.resolve_latest(landed, as_of)
        if args.mode == "current":
            chosen = landed.filter((F.col("year") == latest[0]) & (F.col("month") == latest[1]))
        else:
            chosen = landing.select_historical(landed, latest, args.base_year, args.strict_reference)
        manifest = landing.landing_manifest(spark, args.raw).join(chosen, ["year", "month"], "left_semi")
        record = landing.manifest_record(manifest, args.mode, latest, job_run_id=args.job_run_id,
                                         duplicate_files_skipped=skipped)
        out = {"latest": f"{latest[0]:04d}-{latest[1]:02d}", "marker": landing.write_manifest(record, args.marker)}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
