"""Run one registered report over a data set root and publish it as Parquet.

    spark-submit -m tallyframe.jobs.report NAME ROOT OUTPUT
    python -m tallyframe.jobs.report revenue_by_category /data/sf100 /data/out/category

ROOT holds one folder (or file) per table, ``<ROOT>/<table>.parquet``.  The
report is computed once and written; nothing is collected to the driver.
"""

from __future__ import annotations

import argparse
import sys

from tallyframe.plans.catalog import QUERIES
from tallyframe.sinks.files import write_parquet


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("name", choices=sorted(QUERIES))
    parser.add_argument("root")
    parser.add_argument("output")
    try:
        args = parser.parse_args(argv)
    except SystemExit as exc:  # usage errors exit 1, like other failures
        return 0 if exc.code == 0 else 1
    from tallyframe.session import build_session

    spark = build_session(app_name=f"report-{args.name}")
    try:
        report = QUERIES[args.name](spark, args.root)
        write_parquet(report, args.output, source_paths=[args.root], swap=True)
        return 0
    except Exception as exc:
        print(f"report {args.name} failed: {exc}", file=sys.stderr)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
