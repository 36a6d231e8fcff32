"""Runnable jobs: ``spark-submit tidewater/jobs.py <job> [options]``.

* ``ingest``          topic (Kafka, or replay files) -> decode -> hour ->
                      landed Parquet by date and hour; runs until stopped
                      (``--once`` processes what is there and stops)
* ``filter-csv``      rows (the smoke job's inline people, or a Parquet
                      path) -> equality filter -> preview -> CSV overwrite
* ``copy-partition``  one ``event_date`` directory of the landed table ->
                      first N rows -> preview -> Parquet overwrite
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tidewater.functions.schema import TOPIC  # noqa: E402
from tidewater.operators.basic import take_rows, where_equals  # noqa: E402
from tidewater.operators.sinks import overwrite_csv, overwrite_parquet, preview  # noqa: E402
from tidewater.session import build_session, pin_utc, ship_package  # noqa: E402
from tidewater.sources.envelope import event_envelope  # noqa: E402
from tidewater.sources.inline import people  # noqa: E402
from tidewater.sources.landed import read_partition_dir  # noqa: E402
from tidewater.streaming.ingest import MetricsLog, run_ingest, start_ingest  # noqa: E402


def _session(args, app: str) -> SparkSession:
    spark = build_session(
        app=app, hive=getattr(args, "hive", False), metastore_uri=getattr(args, "metastore_uri", None),
        shuffle_partitions=args.shuffle_partitions, largest_shuffle_bytes=args.largest_shuffle_bytes)
    pin_utc(spark)
    ship_package(spark)
    return spark


def ingest(args) -> None:
    spark = _session(args, "tidewater-ingest")
    env = event_envelope(
        spark, args.kind, path=args.path, brokers=args.brokers, topic=args.topic,
        starting=args.starting, checkpoint=args.checkpoint, group_id=args.group_id,
        min_partitions=args.min_partitions, max_files_per_trigger=args.max_files_per_trigger,
        max_offsets_per_trigger=args.max_offsets_per_trigger,
    )
    log = MetricsLog(spark, args.metrics_root) if args.metrics_root else None
    q = start_ingest(env, args.root, args.checkpoint, every=args.every, once=args.once,
                     engine=args.engine, query_name="ingest", rejects=args.rejects, once_within=args.once_within)
    run_ingest(q)
    if log:
        log.close(q)


def filter_csv(args) -> None:
    spark = _session(args, "tidewater-filter-csv")
    rows = spark.read.parquet(args.input) if args.input else people(spark)
    if args.show:
        preview(rows)
    kept = where_equals(rows, args.column, args.value)
    if args.show:
        preview(kept)
    overwrite_csv(kept, args.out)


def copy_partition(args) -> None:
    spark = _session(args, "tidewater-copy-partition")
    rows = take_rows(read_partition_dir(spark, args.root, args.date), args.limit,
                     order_by=args.order_by or None)
    overwrite_parquet(rows, args.out)
    if args.show:  # what was stored: an unordered limit may pick other rows each time it runs
        preview(spark.read.parquet(args.out))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewater.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("ingest", help="stream events into the landed table")
    s.add_argument("--kind", choices=("kafka", "replay"), default="kafka")
    s.add_argument("--brokers", help="Kafka bootstrap servers")
    s.add_argument("--path", help="replay files (kind=replay)")
    s.add_argument("--topic", default=TOPIC)
    s.add_argument("--group-id")
    s.add_argument("--starting", default="latest")
    s.add_argument("--root", required=True, help="landed table root")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--every", default="120 seconds")
    s.add_argument("--once", action="store_true")
    s.add_argument("--engine", choices=("auto", "python", "jvm"), default="auto")
    s.add_argument("--min-partitions", type=int)
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--max-offsets-per-trigger", type=int, help="bound a Kafka micro-batch (backlog catch-up)")
    s.add_argument("--rejects", action="store_true", help="land undecodable records too, marked as rejected")
    s.add_argument("--once-within", help="drop records delivered again within this time, e.g. '6 hours'")
    s.add_argument("--metrics-root", help="Parquet table of one row per micro-batch")
    s.set_defaults(run=ingest)

    s = sub.add_parser("filter-csv", help="equality filter, written as CSV")
    s.add_argument("--input", help="Parquet input (default: the inline people rows)")
    s.add_argument("--column", default="location")
    s.add_argument("--value", default="San Francisco")
    s.add_argument("--out", required=True)
    s.add_argument("--show", action="store_true")
    s.set_defaults(run=filter_csv)

    s = sub.add_parser("copy-partition", help="first rows of one date, written as Parquet")
    s.add_argument("--root", required=True, help="landed table root")
    s.add_argument("--date", required=True, help="event_date value, e.g. 20240101")
    s.add_argument("--limit", type=int, default=100)
    s.add_argument("--order-by", help="column for a deterministic selection")
    s.add_argument("--out", required=True)
    s.add_argument("--show", action="store_true")
    s.add_argument("--hive", action="store_true", help="Hive-enabled session (cluster metastore)")
    s.add_argument("--metastore-uri", help="metastore address (default: the cluster's hive-site.xml)")
    s.set_defaults(run=copy_partition)
    for s in sub.choices.values():
        s.add_argument("--shuffle-partitions", type=int)
        s.add_argument("--largest-shuffle-bytes", type=int, help="size the shuffle partitions for this many bytes")
    return p


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    args.run(args)


if __name__ == "__main__":
    main()
