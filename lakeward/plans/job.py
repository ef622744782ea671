"""Batch job entry point (``spark-submit``).

    spark-submit lakeward/plans/job.py build    --input-glob 's3://bucket/raw/*.csv' --output-root s3://bucket/wh
    spark-submit lakeward/plans/job.py validate --input-glob ... --output-root ...
    spark-submit lakeward/plans/job.py snapshot --input-glob ... --output-root ...

The session comes from the submit configuration (no master is set here); one that
the job itself started is stopped at its end. Without ``--shuffle-partitions`` the
number of shuffle partitions follows from the bytes of the input: AQE only ever
lowers it.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from lakeward.config import DEFAULT, Settings  # noqa: E402
from lakeward.plans.build import build_all  # noqa: E402
from lakeward.plans.validate import snapshot, snapshot_json, validate  # noqa: E402
from lakeward.session import builder  # noqa: E402
from lakeward.sources.batches import input_bytes  # noqa: E402
from lakeward.sources.layout import relative_paths  # noqa: E402


#: Bytes of input for each shuffle partition.
PARTITION_BYTES = 128 << 20


def widen_shuffles(spark: SparkSession, paths: str) -> None:
    """Raise the session's shuffle partitions to what the input needs."""
    try:
        needed = -(-input_bytes(spark, paths) // PARTITION_BYTES)
    except AnalysisException:
        return  # no such input: the command itself says so
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.shuffle.partitions", str(max(now, needed)))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Order-event medallion build and validation on Spark")
    parser.add_argument("command", choices=["build", "validate", "snapshot"])
    parser.add_argument("--input-glob", required=True)
    parser.add_argument("--output-root", required=True)
    parser.add_argument("--money-total-type", default=DEFAULT.money_total_type)
    parser.add_argument("--shuffle-partitions", type=int, default=None,
                        help="initial shuffle partitions; size for ~128-256 MB per partition of the largest "
                             "shuffle (dedupe), AQE coalesces the small ones")
    parser.add_argument("--multiline", action="store_true",
                        help="accept quoted line breaks in the CSV input (one task per file)")
    parser.add_argument("--silver-buckets", type=int, default=DEFAULT.silver_buckets,
                        help="write silver in so many buckets of event_id, so that validation counts its keys "
                             "without a shuffle (0: no buckets); as many as shuffle partitions of 128-256 MB")
    args = parser.parse_args(argv)
    settings = Settings(money_total_type=args.money_total_type, multiline_csv=args.multiline,
                        silver_buckets=args.silver_buckets)

    own = SparkSession.getActiveSession() is None
    spark = builder("lakeward-job", shuffle_partitions=args.shuffle_partitions).getOrCreate()
    try:
        return run(spark, args, settings)
    finally:
        if own:
            spark.stop()


def run(spark: SparkSession, args: argparse.Namespace, settings: Settings) -> int:
    if args.shuffle_partitions is None:
        widen_shuffles(spark, args.input_glob)
    if args.command == "build":
        paths = build_all(spark, args.input_glob, args.output_root, settings)
        print(json.dumps({"artifacts": relative_paths(args.output_root, paths)}, indent=2))
    elif args.command == "validate":
        summary = validate(spark, args.output_root, args.input_glob, settings)
        print(json.dumps({"validation": summary.to_dict()}, indent=2, default=str))
    else:
        print(snapshot_json(snapshot(spark, args.input_glob, args.output_root, settings)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
