"""Header CSV with malformed lines kept apart instead of read as something else.

Spark's CSV reader pads a short line, cuts a long one and reads on after a
quote that never closes; the row then looks like any other.  Here each line is
scanned as text, parsed by Spark's own ``from_csv``, and given a reason if it
does not fit the columns:

``open_quote``  a cell that starts with a quote which does not end the cell
``short``       fewer cells than columns
``long``        more cells than columns
``type``        a filled cell that does not parse under its declared type
                (only with ``reject_types``; else the cell is null)

in this order, the first that holds.  ``load_with_quarantine`` parses the input
once and writes kept rows and rejected lines in one job, so a restart of a lost
task repeats one file and no second pass over the input is needed.

The dialect is that of Spark's reader and writer: comma, ``"``, and ``\\`` before
a quote inside a quoted cell.  Defined cases: blank lines are skipped; a line
equal to the header is one, wherever it stands (files put together repeat it); an empty cell is null; a cell over several lines is not
supported, its lines are rejected; a file without lines gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.sources.csv import read_csv_text

REASONS = ("open_quote", "short", "long", "type")


def _bare(line: Column) -> Column:
    """``line`` without its well-formed quoted cells, so that only separators count."""
    unescaped = F.regexp_replace(line, r'\\["\\]', "")
    # Possessive and without a repeated group: long cells cost neither stack nor time.
    return F.regexp_replace(unescaped, '(^|,)"[^"]*+"(?=,|$)', "$1")


def reject_reason(line: Column, columns: int, corrupt: Column | None = None) -> Column:
    """Why ``line`` does not fit ``columns`` cells; null if it does.

    ``corrupt`` is true where the parser rejected a line of the right shape.
    """
    bare = _bare(line)
    cells = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    reason = (
        F.when(bare.rlike('(^|,)"'), "open_quote")
        .when(cells < columns, "short")
        .when(cells > columns, "long")
    )
    return reason if corrupt is None else reason.when(corrupt, "type")


def _header_line(spark: SparkSession, path: str) -> str:
    """The header as it is written: read as one cell, it is the name of the only column."""
    reader = spark.read.option("header", True).option("sep", "\u0001").option("quote", "")
    return reader.csv(path).columns[0]


def _fields(text: DataFrame, schema: T.StructType | None) -> tuple[list[T.StructField], list[str]]:
    """The header's columns, each under its declared type or as text, and the declared ones in declared order."""
    if schema is None:
        return [T.StructField(c, T.StringType()) for c in text.columns], text.columns
    declared = {f.name.lower(): f for f in schema}
    missing = set(declared) - {c.lower() for c in text.columns}
    if missing:
        raise ValueError(f"the header has no column {', '.join(sorted(missing))}; it has {', '.join(text.columns)}")
    return [declared.get(c.lower(), T.StructField(c, T.StringType())) for c in text.columns], schema.names


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def checked_lines(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, reject_types: bool = False
) -> DataFrame:
    """Every data line of ``path``: ``file, line, reason`` and the struct ``row``.

    The columns of ``schema`` are found in the header by name and make up
    ``row``; without a schema all columns do, as text.  A line is measured
    against all columns of the header.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields, wanted = _fields(read_csv_text(spark, path), schema)
    corrupt = "corrupt"
    while corrupt in {f.name.lower() for f in fields}:
        corrupt += "_"
    ddl = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields) + f", {corrupt} string"
    line = F.regexp_replace("value", "^\uFEFF", "")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), line.alias("line"))
    data = lines.where((F.trim("line") != "") & (F.col("line") != _header_line(spark, path)))
    parsed = data.withColumn("parsed", F.from_csv("line", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}))
    bad_cell = F.col("parsed").getField(corrupt).isNotNull() if reject_types else None
    row = F.struct(*[F.col("parsed").getField(n).alias(n) for n in wanted])
    return parsed.select("file", "line", reject_reason(F.col("line"), len(fields), bad_cell).alias("reason"), row.alias("row"))


def kept_rows(lines: DataFrame) -> DataFrame:
    """The rows of the lines that fit."""
    return lines.where("reason IS NULL").select("row.*")


def rejected_lines(lines: DataFrame) -> DataFrame:
    """``reason, file, line`` of the lines that do not fit."""
    return lines.where("reason IS NOT NULL").select("reason", "file", "line")


@dataclass(frozen=True)
class Quarantined:
    """What a load kept and what it put aside; both read the written files."""

    rows: DataFrame
    rejected: DataFrame

    def counts(self) -> DataFrame:
        """``reason, n_files, n_lines`` of the rejected lines."""
        return self.rejected.groupBy("reason").agg(
            F.count_distinct("file").alias("n_files"), F.count(F.lit(1)).alias("n_lines")
        )


def load_with_quarantine(
    spark: SparkSession,
    path: str,
    out: str,
    schema: T.StructType | str | None = None,
    reject_types: bool = False,
) -> Quarantined:
    """Parse ``path`` once into Parquet at ``out``, kept rows and rejected lines side by side.

    The folder is partitioned by ``kept``; a reader of either side opens no
    file of the other.  Rejected lines carry no row, kept rows no line.
    """
    lines = checked_lines(spark, path, schema, reject_types)
    kept = F.col("reason").isNull()
    sides = lines.select(
        F.when(kept, F.col("row")).alias("row"), "reason",
        *[F.when(~kept, F.col(c)).alias(c) for c in ("file", "line")],
        F.when(kept, "yes").otherwise("no").alias("kept"),
    )
    sides.write.mode("errorifexists").partitionBy("kept").parquet(out)
    # Declared: a side without lines has no folder to learn the columns from.
    written = spark.read.schema(sides.schema).parquet(out)
    return Quarantined(
        written.where("kept = 'yes'").select("row.*"),
        written.where("kept = 'no'").select("reason", "file", "line"),
    )
