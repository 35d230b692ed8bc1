"""Mixing sources to target weights.

Each document gets a hash-random key.  Within its source the documents are put
in key order, prefix sums of their sizes are taken, and the order is cut at
the source's exact budget: documents before the cut are taken, the one across
it in part, and where the budget exceeds the source the order is walked again
(another epoch).

The order is never sorted in one task: a source is cut into key ranges of
about ``rows_per_range`` rows (keys are uniform, so a source with a third of
all rows only has more ranges), ranges are summed first, and a row's prefix is
its range's offset plus its place inside the range.

Defined cases: a null text has size 0 and takes nothing; a null source is a
source of its own, last in order; a null ``doc_id`` is keyed as empty text;
equal keys are ordered by ``doc_id`` and text hash, and rows equal in both are
interchangeable; an empty table gives an empty result.  Results are one struct
column, so clashing column names of the input do not matter.

One row per source is brought to the driver to set the targets; a source list
is a small dimension (names of crawls and collections), not a table that grows
with the documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import WORD_PATTERN, free_name, free_prefix
from tallyframe.operators.joins import checked_broadcast

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
ROWS_PER_RANGE = 4096
KEY_BITS = 60


def word_count(text: str) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def random_key(doc_id: str, seed: str = "mix") -> Column:
    """A uniform 60-bit key fixed by the id and the seed."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def targets(sizes: Sequence[int], weights: Sequence[float], budget: float, max_epochs: float) -> list[float]:
    """Budget shared by weight, no share above ``max_epochs`` times its size.

    The excess of the capped shares goes to the others by weight until none is
    above its cap: the level of a water filling, found over the caps in order
    of cap per weight.
    """
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: max_epochs * sizes[i] / weights[i])
    left, open_weight = float(budget), float(sum(weights))
    for place, i in enumerate(order):
        cap = float(max_epochs * sizes[i])
        if left / open_weight * weights[i] <= cap:
            level = left / open_weight
            for j in order[place:]:
                out[j] = level * weights[j]
            break
        out[i] = cap
        left -= cap
        open_weight -= weights[i]
    return out


def _source_table(sized: DataFrame, p: str, share: float, weights, max_epochs, rows_per_range: int) -> DataFrame:
    """One row per source: its target, whole epochs, remaining words and number of key ranges."""
    spark = sized.sparkSession
    totals = sized.groupBy(F.col(f"{p}source").alias("source")).agg(
        F.sum(f"{p}size").alias("size"), F.count(F.lit(1)).alias("n")
    ).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["size"] or 0) for r in totals]
    weight = [float(weights[i % len(weights)]) for i in range(len(totals))]
    target = targets(sizes, weight, share * sum(sizes), max_epochs) if totals else []
    rows = []
    for i, (r, size, t) in enumerate(zip(totals, sizes, target, strict=True)):
        words = int(t + 1e-6)
        epochs = words // size if size else 0
        rows.append((r["source"], i, size, t, epochs, words - epochs * size, -(-int(r["n"]) // rows_per_range)))
    return spark.createDataFrame(rows, T.StructType([
        T.StructField(f"{p}name", sized.schema[f"{p}source"].dataType),
        T.StructField(f"{p}src", T.IntegerType()),
        T.StructField(f"{p}source_size", T.LongType()),
        T.StructField(f"{p}target", T.DoubleType()),
        T.StructField(f"{p}epochs", T.LongType()),
        T.StructField(f"{p}rest", T.LongType()),
        T.StructField(f"{p}ranges", T.LongType()),
    ]))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> tuple[DataFrame, str]:
    """``docs`` with a struct ``{size, source_size, target, taken, copies}``.

    ``taken``: words the mix takes of the row, repeats counted, exact to the
    source's budget.  ``copies``: how often the row starts in the mix, so a row
    cut by the budget counts whole.  Returns the frame and the struct's name.
    """
    name, p = free_name(docs, "mix"), free_prefix(docs, "_mix_")
    keyed = docs.withColumns({
        f"{p}source": F.col(source),
        f"{p}size": word_count(text),
        f"{p}text": F.xxhash64(F.col(text)),
        f"{p}key": random_key(doc_id),
    })
    sources = _source_table(keyed, p, share, weights, max_epochs, rows_per_range)
    placed = keyed.join(checked_broadcast(sources), F.col(f"{p}source").eqNullSafe(F.col(f"{p}name")))
    # Key ranges of equal width: the top 32 key bits scaled to the range count.
    top = F.shiftright(F.col(f"{p}key"), KEY_BITS - 32)
    placed = placed.withColumn(f"{p}range", F.shiftright(top * F.col(f"{p}ranges"), 32))
    slot = [f"{p}src", f"{p}range"]
    sums = placed.groupBy(*slot).agg(F.sum(f"{p}size").alias("range_size"))
    earlier = Window.partitionBy(slot[0]).orderBy(slot[1]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*slot, F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias(f"{p}offset"))
    inside = Window.partitionBy(*slot).orderBy(f"{p}key", doc_id, f"{p}text").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn(f"{p}before", F.coalesce(F.sum(f"{p}size").over(inside), F.lit(0)))
    placed = placed.join(offsets, slot)
    left = F.col(f"{p}rest") - F.col(f"{p}offset") - F.col(f"{p}before")
    part = F.greatest(F.lit(0), F.least(F.col(f"{p}size"), left))
    info = F.struct(
        F.col(f"{p}size").alias("size"),
        F.col(f"{p}source_size").alias("source_size"),
        F.col(f"{p}target").alias("target"),
        (F.col(f"{p}epochs") * F.col(f"{p}size") + part).cast("bigint").alias("taken"),
        (F.col(f"{p}epochs") + F.when(part > 0, 1).otherwise(0)).cast("int").alias("copies"),
    )
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], info.alias(name)), name


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows: each row of ``docs`` as often as the mix starts it, columns of ``docs``."""
    mixed, name = mix(docs, **options)
    copy = free_name(mixed, "copy")
    repeated = mixed.filter(F.col(name)["copies"] > 0).withColumn(
        copy, F.explode(F.sequence(F.lit(1), F.col(name)["copies"]))
    )
    return repeated.drop(name, copy)
