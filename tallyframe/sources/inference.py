"""Types of a header CSV, found by one aggregate over its text.

Every cell is given the most specific type it fits, once; the counts per type
are summed for all columns in one pass (partial sums per task, one row comes
back).  A column's type is the meet of its cells' types on this lattice::

    int < bigint < decimal < double      date < timestamp      boolean

and ``string`` above all.  So the counts also say how many cells a type would
reject, without a second pass: with a ``tolerance`` a column takes the most
specific type that rejects at most that share of its filled cells, and rejected
cells are read as null.  With tolerance 0 the types are those of Spark's own
inference, apart from numbers spelled ``12d`` or ``12f``, which stay text.

Defined cases: an empty cell is null and fits every type; a column without
filled cells is ``string``; a cell with blanks around a value fits ``string``
only; a header without rows gives ``string`` columns; column names that hold
dots are taken as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.sources.csv import read_csv_text

INTEGER = r"^[+-]?[0-9]+$"
NUMBER = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|NaN|-?Inf)$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$"
BOOLEAN = "^(?i:true|false)$"
MAX_DIGITS = 38

# Most specific first; a cell of one type fits the types listed for it.
FITS = {
    "int": ("int", "bigint", "decimal", "double"),
    "bigint": ("bigint", "decimal", "double"),
    "decimal": ("decimal", "double"),
    "double": ("double",),
    "date": ("date", "timestamp"),
    "timestamp": ("timestamp",),
    "boolean": ("boolean",),
    "string": (),
}
TYPES = [t for t in FITS if t != "string"]
_SHAPE = {"int": INTEGER, "bigint": INTEGER, "decimal": INTEGER, "double": NUMBER, "date": DATE, "timestamp": TIMESTAMP,
          "boolean": BOOLEAN}


def _digits(cell: Column) -> Column:
    return F.length(F.regexp_replace(cell, "^[+-]?0*", ""))


def cell_type(cell: Column) -> Column:
    """The most specific type that a cell fits; null for an empty cell."""
    whole = cell.rlike(INTEGER)
    return (
        F.when(cell.isNull(), F.lit(None).cast("string"))
        .when(whole & cell.try_cast("int").isNotNull(), "int")
        .when(whole & cell.try_cast("bigint").isNotNull(), "bigint")
        .when(whole & (_digits(cell) <= MAX_DIGITS), "decimal")
        .when(cell.rlike(NUMBER), "double")
        .when(cell.rlike(DATE) & cell.try_cast("date").isNotNull(), "date")
        .when(cell.rlike(TIMESTAMP) & cell.try_cast("timestamp").isNotNull(), "timestamp")
        .when(cell.rlike(BOOLEAN), "boolean")
        .otherwise("string")
    )


@dataclass(frozen=True)
class ColumnFacts:
    """What the pass found in one column."""

    name: str
    rows: int
    counts: dict[str, int]   # filled cells by their most specific type
    digits: int              # most digits of a whole number beyond bigint

    @property
    def filled(self) -> int:
        return sum(self.counts.values())

    def rejected(self, kind: str) -> int:
        """Filled cells that do not fit a type."""
        if kind == "string":
            return 0
        return sum(n for t, n in self.counts.items() if kind not in FITS[t])

    def choose(self, tolerance: float = 0.0) -> str:
        """The most specific type that rejects at most ``tolerance`` of the filled cells."""
        if self.filled:
            for kind in TYPES:
                if self.rejected(kind) <= tolerance * self.filled:
                    return kind
        return "string"

    def data_type(self, tolerance: float = 0.0) -> T.DataType:
        kind = self.choose(tolerance)
        if kind == "decimal":
            return T.DecimalType(max(self.digits, 19), 0)
        return T.StringType() if kind == "string" else T.StructType.fromDDL(f"c {kind}")[0].dataType


def column_facts(text: DataFrame) -> list[ColumnFacts]:
    """Facts about every column of an all-text frame, in one aggregate."""
    if not text.columns:
        return []
    cells = [F.col(f"`{c}`") for c in text.columns]
    typed = text.select(*[F.struct(cell_type(c).alias("t"), c.alias("v")).alias(f"c{i}") for i, c in enumerate(cells)])
    sums = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(cells)):
        kind, value = F.col(f"c{i}.t"), F.col(f"c{i}.v")
        sums += [F.count_if(kind == t).alias(f"n{i}_{t}") for t in FITS]
        sums.append(F.max(F.when(kind == "decimal", _digits(value))).alias(f"d{i}"))
    row = typed.agg(*sums).first()
    return [ColumnFacts(name, row["rows"], {t: row[f"n{i}_{t}"] for t in FITS}, row[f"d{i}"] or 0)
            for i, name in enumerate(text.columns)]


def converted(text: DataFrame, facts: list[ColumnFacts], tolerance: float = 0.0) -> DataFrame:
    """``text`` under its inferred types; a cell that does not fit is null."""
    out = []
    for fact in facts:
        cell, kind = F.col(f"`{fact.name}`"), fact.choose(tolerance)
        if kind == "string":
            out.append(cell.alias(fact.name))
            continue
        fits = cell.rlike(_SHAPE[kind])
        if kind == "timestamp":
            fits = fits | cell.rlike(DATE)
        # Java's words for the infinities.
        value = F.regexp_replace(cell, "^(-?)Inf$", "$1Infinity") if kind == "double" else cell
        out.append(F.when(fits, value.try_cast(fact.data_type(tolerance))).alias(fact.name))
    return text.select(*out)


def read_csv_inferred(spark: SparkSession, path: str, tolerance: float = 0.0) -> tuple[DataFrame, list[ColumnFacts]]:
    """A header CSV under inferred types, and the facts the types rest on."""
    text = read_csv_text(spark, path)
    facts = column_facts(text)
    return converted(text, facts, tolerance), facts


def inference_report(spark: SparkSession, facts: list[ColumnFacts], tolerance: float = 0.0) -> DataFrame:
    """One row per column: ``column, type, n_rows, filled, rejected``."""
    rows = [(f.name, f.data_type(tolerance).simpleString(), f.rows, f.filled, f.rejected(f.choose(tolerance))) for f in facts]
    return spark.createDataFrame(rows, "column string, type string, n_rows bigint, filled bigint, rejected bigint")
