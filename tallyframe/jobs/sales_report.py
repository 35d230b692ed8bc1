"""Per-product sales metrics from a path given to the job.

    python -m tallyframe.jobs.sales_report INPUT [OUTPUT] [--format csv|parquet]
        [--product COL --amount COL --quantity COL] [--schema DDL | --infer]
        [--quarantine FOLDER]

INPUT may be any Hadoop file system URI (local, ``hdfs://``, ``s3a://``; the
latter needs the ``hadoop-aws`` package on the classpath).  Without OUTPUT the
metrics are only shown on the console.  The metrics are computed once: when
an OUTPUT is given they are written, and the preview reads the written files
instead of running the aggregation a second time.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tallyframe.plans.reports import product_sales_metrics
from tallyframe.sinks.files import data_file_name, write_parquet
from tallyframe.sources.csv import read_csv_typed
from tallyframe.sources.quarantine import load_with_quarantine


def detect_format(spark: SparkSession, path: str) -> str:
    """``csv`` or ``parquet``, from the names of the input's own files."""
    name = data_file_name(spark, path)
    if name is None:
        raise ValueError(f"{path!r} holds no data file; give --format")
    parts = name.lower().split(".")
    if "parquet" in parts:
        return "parquet"
    if "csv" in parts or "txt" in parts:
        return "csv"
    raise ValueError(f"cannot tell the format of {name!r}; give --format")


def load_input(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: str | None = None,
    infer: bool = False,
    quarantine_path: str | None = None,
) -> DataFrame:
    """Input rows from CSV or Parquet.

    CSV needs ``schema``, a DDL string (``"ProductID INT, Amount DOUBLE, ..."``)
    whose columns are found in the header by name, or ``infer=True``, which
    costs an extra pass.  Parquet brings its own schema.

    With ``quarantine_path`` (CSV with a schema) lines that do not fit are put
    aside in that new folder, with their file and the reason, beside the rows
    read from the others.
    """
    fmt = fmt or detect_format(spark, path)
    if quarantine_path is not None:
        if fmt != "csv" or schema is None:
            raise ValueError("a quarantine needs CSV input with a schema (--schema)")
        return load_with_quarantine(spark, path, quarantine_path, schema, reject_types=True).rows
    if fmt == "csv":
        if schema is None and not infer:
            raise ValueError("CSV input needs a schema (--schema) or inference (--infer)")
        return read_csv_typed(spark, path, None if infer else schema, infer=infer)
    if fmt == "parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    raise ValueError(f"unknown input format {fmt!r}")


def run_sales_report(
    spark: SparkSession,
    input_path: str,
    output_path: str | None = None,
    fmt: str | None = None,
    product: str = "l_partkey",
    amount: str = "l_extendedprice",
    quantity: str = "l_quantity",
    schema: str | None = None,
    infer: bool = False,
    quarantine_path: str | None = None,
) -> DataFrame:
    """Metrics per ``product``; written as Parquet, in order, when ``output_path`` is set.

    The frame returned for an output reads the written files and is not sorted
    again.
    """
    rows = load_input(spark, input_path, fmt, schema, infer, quarantine_path)
    missing = [c for c in (product, amount, quantity) if c.lower() not in {x.lower() for x in rows.columns}]
    if missing:
        raise ValueError(f"the input has no column {', '.join(missing)}; it has {', '.join(rows.columns)}")
    metrics = product_sales_metrics(rows, product, amount, quantity)
    if output_path is None:
        return metrics
    write_parquet(metrics, output_path, source_paths=[input_path], swap=True)
    return spark.read.parquet(output_path)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("input")
    parser.add_argument("output", nargs="?")
    parser.add_argument("--format", choices=["csv", "parquet"])
    parser.add_argument("--product", default="l_partkey")
    parser.add_argument("--amount", default="l_extendedprice")
    parser.add_argument("--quantity", default="l_quantity")
    parser.add_argument("--schema", help="DDL of the columns to read, found by name, e.g. 'ProductID INT, Amount DOUBLE'")
    parser.add_argument("--infer", action="store_true", help="infer CSV types (an extra pass over the input)")
    parser.add_argument("--quarantine", help="new folder for rows that fit and, beside them, lines that do not")
    parser.add_argument("--preview", type=int, default=20)
    try:
        args = parser.parse_args(argv)
    except SystemExit as exc:  # usage errors exit 1, like other failures
        return 0 if exc.code == 0 else 1
    from tallyframe.session import build_session

    spark = build_session(app_name="sales_report")
    try:
        report = run_sales_report(
            spark, args.input, args.output, args.format,
            args.product, args.amount, args.quantity, args.schema, args.infer, args.quarantine,
        )
        report.orderBy(args.product).limit(args.preview).show(args.preview, truncate=False)
        return 0
    except Exception as exc:  # report and fail the job with a non-zero code
        print(f"sales_report failed: {exc}", file=sys.stderr)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
