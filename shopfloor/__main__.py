"""Command line: ``python -m shopfloor etl|check ...``.

  etl   --sensor PATH --quality PATH --out PATH [--days-back N] [--null-keys match|sql] ...
  check --out PATH [--report PATH]
  sql   --out PATH (--to PATH | --preview N) "SELECT ... FROM hourly_summary ..."

``etl --help`` lists the settings for large inputs.  ``sql --to`` writes the
whole result as Parquet; ``--preview`` prints its first rows.

The session comes from the environment (spark-submit on a cluster);
``--local N`` starts a local one instead.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from . import session
from .operators.integrate import MAX_NULL_PAIRS
from .plans import etl


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="shopfloor")
    ap.add_argument("--local", type=int, default=None, help="run on local[N]")
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl")
    e.add_argument("--sensor", required=True)
    e.add_argument("--quality", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--days-back", type=int, default=None)
    e.add_argument("--sensor-schema", type=json.loads, help='declared types, e.g. {"Temperature": "double"}')
    e.add_argument("--quality-schema", type=json.loads)
    e.add_argument("--quality-encoding", default=None, help="probed unless given")
    e.add_argument("--multi-line", choices=("yes", "no"), default=None,
                   help="whether quoted fields span lines; probed unless given")
    e.add_argument("--null-keys", choices=("match", "sql"), default="match",
                   help="whether rows without time or machine join each other")
    e.add_argument("--max-null-pairs", type=int, default=MAX_NULL_PAIRS)
    e.add_argument("--dedupe-checks", choices=("none", "latest"), default="none")
    e.add_argument("--partition-days", action="store_true")
    e.add_argument("--malformed", choices=["keep", "quarantine"], default="keep",
                    help="rows with too few or too many fields: read them, or write them to OUT/quarantine and count them")
    e.add_argument("--keep-runs", type=int, default=None)
    c = sub.add_parser("check")
    c.add_argument("--out", required=True)
    c.add_argument("--report", default=None, help="also write the K11 report table here")
    q = sub.add_parser("sql")
    q.add_argument("--out", required=True)
    q.add_argument("query")
    shown = q.add_mutually_exclusive_group(required=True)
    shown.add_argument("--to", help="write the whole result here (Parquet)")
    shown.add_argument("--preview", type=int, help="print this many rows")
    args = ap.parse_args(argv)

    spark = (session.local_session(args.local) if args.local
             else session.configure(SparkSession.builder.getOrCreate()))
    if args.cmd == "etl":
        rep = etl.run_etl_pipeline(
            spark, args.sensor, args.quality, args.out, days_back=args.days_back,
            sensor_schema=args.sensor_schema, quality_schema=args.quality_schema,
            quality_encoding=args.quality_encoding,
            multi_line=None if args.multi_line is None else args.multi_line == "yes",
            null_keys=args.null_keys, max_null_pairs=args.max_null_pairs, dedupe_checks=args.dedupe_checks,
            partition_days=args.partition_days, keep_runs=args.keep_runs, malformed=args.malformed)
        if rep is None:
            print(json.dumps({"status": "failed", "reason": "no sensor data"}))
            return 1
        print(json.dumps({"status": "ok", "run_id": rep.run_id, "rows": rep.rows}))
        return 0
    if args.cmd == "check":
        ok, report = etl.test_database_integrity(spark, args.out)
        if args.report:
            report.write.mode("overwrite").parquet(args.report)
        report.show(report.count(), truncate=False)      # one row per check
        print(json.dumps({"all_passed": ok}))
        return 0 if ok else 2
    etl.register_views(spark, args.out)
    result = spark.sql(args.query)
    if args.to:
        result.write.mode("errorifexists").parquet(args.to)
    else:
        result.show(args.preview, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
