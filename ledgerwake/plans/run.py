"""Build all models from the landing tables and test them.

``python -m ledgerwake.plans.run --raw <folder> --out <folder>``
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from ledgerwake.params import Params
from ledgerwake.plans import pipeline
from ledgerwake.plans.checks import CHECKS
from ledgerwake.session import build_session
from ledgerwake.sources.raw import load_raw


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw", required=True, help="folder of the landing tables")
    parser.add_argument("--out", required=True, help="folder for the model tables")
    parser.add_argument("--prefix", default="main_", help="catalog databases start with this")
    parser.add_argument("--start", type=dt.date.fromisoformat, default=Params.date_start)
    parser.add_argument("--end", type=dt.date.fromisoformat, default=None)
    parser.add_argument("--days", action="store_true",
                        help="partition the trade fact by day; worth it for large feeds")
    parser.add_argument("--keep-builds", type=int, default=2,
                        help="complete builds of each table that stay on disk")
    args = parser.parse_args()
    spark = build_session("ledgerwake-build")
    models = pipeline.run(
        spark, load_raw(spark, args.raw), args.out, Params(args.start, args.end), args.prefix,
        {"fact_trades": ["trade_date"]} if args.days else None,
        layers_as={"metrics": pipeline.TABLE}, keep_builds=args.keep_builds)
    # A fixed list of declared checks, one small row each.
    summary = pipeline.check(models).orderBy(F.desc("failures"), "model", "column_name", "kind")
    summary.write.mode("overwrite").parquet(f"{args.out}/check_summary")
    failing = spark.read.parquet(f"{args.out}/check_summary").filter("failures > 0")
    failing.show(len(CHECKS), truncate=False)
    failed = not failing.isEmpty()
    spark.stop()
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
