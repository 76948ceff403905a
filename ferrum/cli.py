"""Command-line entry points for the scheduled jobs.

    python -m ferrum.cli ingest-signals --source RAW_JSON --target SIGNALS [--table NAME] [--as-of TS]
    python -m ferrum.cli land-messages --source QUEUE_DIR --target LANDING --checkpoint DIR [--max-files N]
    python -m ferrum.cli retention --database DB --ts-column COL --days N [--erase "700=c1,c2"] --as-of TS

Each command builds (or joins) a Spark session and runs one job; all paths
should be shared storage. ``--as-of`` defaults to the current time, read once
at the start and passed down.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from ferrum.session import BASE_CONF, ensure_utc


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("ferrum")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def ingest_signals(spark: SparkSession, source: str, target: str, as_of: str, table: str | None = None) -> int:
    """Raw signal JSON -> normalised rows appended under name/year/month partitions."""
    from ferrum.operators.signals import SIGNAL_PARTITION_COLUMNS, normalize_signals
    from ferrum.sinks.writers import partitioned_write
    from ferrum.sources.files import read_json
    from ferrum.sources.sql import register_partitioned_table

    raw = read_json(spark, source, schema="vin string, eventDate string, signalName string, signalValue double")
    partitioned_write(normalize_signals(raw, as_of), target, SIGNAL_PARTITION_COLUMNS)
    if table:
        register_partitioned_table(spark, table, target)
    return 0


def land(spark: SparkSession, source: str, target: str, checkpoint: str, max_files: int,
         reprocess_all: bool = False) -> int:
    from ferrum.streaming.landing import land_messages
    q = land_messages(spark, source, target, checkpoint, max_files_per_trigger=max_files,
                      reprocess_all=reprocess_all)
    q.awaitTermination()
    return 1 if q.exception() else 0


def retention(spark: SparkSession, database: str, ts_column: str, days: int, erase: list[str], as_of: str,
              version_root: str, erase_ts_column: str | None = None) -> int:
    from ferrum.operators.retention import apply_retention_to_database
    rules: dict[int, str] = {}
    for item in erase:
        d, cols = item.split("=", 1)
        rules[int(d)] = ",".join(filter(None, [rules.get(int(d), ""), cols]))
    report = apply_retention_to_database(spark, database, ts_column, as_of, days, rules,
                                         version_root, erase_ts_col=erase_ts_column)
    for row in report.collect():  # one row per table
        print(json.dumps(row.asDict()))
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ferrum")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest-signals")
    a.add_argument("--source", required=True)
    a.add_argument("--target", required=True)
    a.add_argument("--table")
    a.add_argument("--as-of")
    b = sub.add_parser("land-messages")
    b.add_argument("--source", required=True)
    b.add_argument("--target", required=True)
    b.add_argument("--checkpoint", required=True)
    b.add_argument("--max-files", type=int, default=10)
    b.add_argument("--reprocess-all", action="store_true")
    c = sub.add_parser("retention")
    c.add_argument("--database", required=True)
    c.add_argument("--ts-column", required=True)
    c.add_argument("--days", type=int, required=True)
    c.add_argument("--erase", action="append", default=[], help='"DAYS=col1,col2", repeatable')
    c.add_argument("--erase-ts-column", help="age column of the erase rules, default --ts-column")
    c.add_argument("--version-root", required=True, help="folder that the rewritten tables live in from then on")
    c.add_argument("--as-of")
    args = p.parse_args(argv)
    spark = _session()
    if args.cmd == "ingest-signals":
        return ingest_signals(spark, args.source, args.target, args.as_of or _now(), args.table)
    if args.cmd == "land-messages":
        return land(spark, args.source, args.target, args.checkpoint, args.max_files, args.reprocess_all)
    return retention(spark, args.database, args.ts_column, args.days, args.erase, args.as_of or _now(),
                     args.version_root, args.erase_ts_column)


if __name__ == "__main__":
    sys.exit(main())
