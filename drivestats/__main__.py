"""Command line / spark-submit entry point for one refresh.

    spark-submit --py-files drivestats.zip -m drivestats hourly INCREMENTAL \\
        --source <positions folder> --target <statistics folder> --database <db> --table <table>

Uses the session the cluster provides (``getOrCreate``); prints the run result
as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from drivestats.plans.grains import GRAINS
from drivestats.operators.pairs import STRATEGIES
from drivestats.plans.job import LATE_ROWS, APPEND, run
from drivestats.sources.gold import LOAD_TYPES


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="drivestats", description="Refresh one driving statistics table.")
    p.add_argument("grain", choices=sorted(GRAINS))
    p.add_argument("load_type", help=f"one of {', '.join(LOAD_TYPES)}")
    p.add_argument("--source", required=True, help="silver positions table (Parquet folder)")
    p.add_argument("--target", required=True, help="gold table folder")
    p.add_argument("--database")
    p.add_argument("--table")
    p.add_argument("--sample-seconds", type=float, default=1.0)
    p.add_argument("--strategy", choices=STRATEGIES, default=STRATEGIES[0])
    p.add_argument("--reprocess-latest", action="store_true")
    p.add_argument("--late-rows", choices=LATE_ROWS, default=APPEND)
    p.add_argument("--zone", default="UTC", help="zone whose wall clock zoned timestamps take")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = spark or SparkSession.builder.appName(f"drivestats-{args.grain}").getOrCreate()
    res = run(
        spark,
        args.grain,
        args.load_type,
        args.source,
        args.target,
        database=args.database,
        table=args.table,
        sample_seconds=args.sample_seconds,
        strategy=args.strategy,
        reprocess_latest=args.reprocess_latest,
        late_rows=args.late_rows,
        zone=args.zone,
    )
    out = {
        "grain": res.grain,
        "load_type": res.load_type,
        "watermark": res.watermark.isoformat() if res.watermark else None,
        "wrote": res.wrote,
        "new_partitions": len(res.partitions),
        "rows_read": res.rows_read,
        "rows_rejected": res.rows_rejected,
        "table": res.table,
    }
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
