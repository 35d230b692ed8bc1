"""CSV sources: all-text reads and typed reads.

The text read keeps every column as ``string`` (no inference pass); values are
converted where they are used with ``try_cast`` so dirty cells become null
instead of failing the job.  The typed read takes a declared schema, whose
columns are found in the header by name; schema inference is available but
costs a full extra pass over the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.schemas import all_strings


def read_csv_text(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Header CSV with every column as text.

    With ``columns`` given no job runs at definition time, and a header with
    other names fails the read; otherwise Spark reads the first line to learn
    the names.
    """
    reader = spark.read.option("header", True)
    if columns is not None:
        reader = reader.option("enforceSchema", False).schema(all_strings(columns))
    else:
        reader = reader.option("inferSchema", False)
    return reader.csv(path)


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    infer: bool = False,
) -> DataFrame:
    """Header CSV with types: declared (preferred) or inferred (extra pass).

    ``schema`` is a ``StructType`` or a DDL string.  Its columns are looked up
    in the header by name, in any order; a column the header lacks is an
    error.  Cells that do not parse under the declared type become null;
    ``rejected_cells`` counts them.
    """
    if schema is None and not infer:
        raise ValueError("give a schema, or pass infer=True to pay for an inference pass")
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    text = read_csv_text(spark, path)
    return text.select(*_converted(text, _declared(schema)))


def _declared(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _names(text: DataFrame, schema: T.StructType) -> list[str]:
    by_name = {c.lower(): c for c in text.columns}
    missing = [f.name for f in schema if f.name.lower() not in by_name]
    if missing:
        raise ValueError(f"the header has no column {', '.join(missing)}; it has {', '.join(text.columns)}")
    return [by_name[f.name.lower()] for f in schema]


def _converted(text: DataFrame, schema: T.StructType) -> list:
    return [F.col(f"`{c}`").try_cast(f.dataType).alias(f.name) for f, c in zip(schema, _names(text, schema), strict=True)]


def rejected_cells(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One row: for each declared column, how many non-empty cells do not parse."""
    schema = _declared(schema)
    text = read_csv_text(spark, path)
    bad = [
        F.count(F.when(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(f.dataType).isNull(), 1)).alias(f.name)
        for f, c in zip(schema, _names(text, schema), strict=True)
    ]
    return text.agg(*bad)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header CSV files, one per task, committed by Spark's output committer."""
    df.write.mode(mode).option("header", True).csv(path)
    return path
