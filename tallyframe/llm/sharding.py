"""Sharding by vector bin packing.

Rows with equal texts form a group and stay together.  Each group is a vector
of bytes, tokens and rows; a group goes to the shard whose residual capacity
has the highest dot product with that vector, largest groups first, so the
three totals are balanced jointly.

Placing is sequential, so it must not see every group: groups below a
``1/BUNDLES`` share of all three totals are first bundled by the hash of their
text into ``BUNDLES`` bundles.  What is placed is at most ``BUNDLES`` bundles
and ``3 * BUNDLES`` large groups, whatever the size of the corpus, and a bundle
is a few ten-thousandths of the total, which bounds the imbalance.  A group too
large for one shard cannot stay whole under any balance; it is cut by the hash
of the id into ``PIECES`` pieces that are placed one by one.

Slots number a shard's rows from 0 without gaps: rows are ranked inside hash
parts of about ``rows_per_part`` rows and each part starts at the running count
of the parts before it, so no task ranks a whole shard.

Defined cases: a null text has size 1, crc 0 and is its own group, apart from
the empty text's; a null id is hashed as a value of its own; rows equal in id
and text are interchangeable; an empty table gives an empty result.  Results
are one struct column.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import free_name, free_prefix
from tallyframe.llm.mixing import word_count

N_SHARDS = 8
BUNDLES = 4096
PIECES = 64
# Emphasis of bytes, tokens and rows in the dot product.
EMPHASIS = (4.0, 2.0, 1.0)
ROWS_PER_PART = 20_000


def place(vectors: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of every vector: largest first, to the highest dot product with the residual capacity.

    Components are scaled to their totals; equal products go to the lower shard.
    """
    total = vectors.sum(axis=0)
    share = vectors / np.where(total > 0, total, 1)
    left = np.full((n_shards, vectors.shape[1]), 1.0 / n_shards)
    emphasis = np.array(EMPHASIS)
    shard = np.zeros(len(vectors), dtype=np.int64)
    for i in np.lexsort((np.arange(len(vectors)), -share.max(axis=1))):
        best = int(np.argmax(left @ (emphasis * share[i])))
        shard[i] = best
        left[best] -= share[i]
    return shard


def assign_shards(
    docs: DataFrame, n_shards: int = N_SHARDS, doc_id: str = "doc_id", text: str = "text",
    bundles: int = BUNDLES, rows_per_part: int = ROWS_PER_PART,
) -> tuple[DataFrame, str]:
    """``docs`` with a struct ``{size, text_crc32, shard, slot}``; returns the frame and the struct's name."""
    spark = docs.sparkSession
    name, p = free_name(docs, "sharding"), free_prefix(docs, "_shard_")
    size, crc, hashed, piece = (f"{p}{x}" for x in ("size", "crc", "hash", "piece"))
    rows = docs.withColumns({
        size: F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint") + 1,
        crc: F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)),
        # A null text hashes to the seed, an empty one does not.
        hashed: F.xxhash64(F.col(text), F.col(text).isNull()),
        piece: F.pmod(F.xxhash64(F.lit("piece"), F.col(doc_id)), F.lit(PIECES)).cast("int"),
    })
    group = [hashed, crc, size]

    # Vectors by group and piece; a group of copies shrinks inside each task
    # and is spread over its pieces in the shuffle.
    pieces = rows.groupBy(*group, piece).agg(
        F.count(F.lit(1)).alias("rows"), F.max(word_count(text)).alias("words")
    ).withColumn("bytes", F.col("rows") * F.col(size)).withColumn("tokens", F.col("rows") * F.col("words"))
    measures = ("bytes", "tokens", "rows")
    groups = pieces.groupBy(*group).agg(*[F.sum(m).alias(m) for m in measures])
    total = groups.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]).first()
    parts = max(1, -(-int(total["rows"]) // (rows_per_part * n_shards)))

    def share_above(limit: float):
        cond = F.lit(False)
        for m in measures:
            cond = cond | (F.col(m) > F.lit(float(total[m]) * limit))
        return cond

    bundle = F.pmod(F.col(hashed), F.lit(bundles))
    kind = F.when(share_above(1.0 / n_shards), 2).when(share_above(1.0 / bundles), 1).otherwise(0)
    sized = groups.withColumn("kind", kind)
    small = sized.filter("kind = 0").groupBy(bundle.alias("bundle")).agg(*[F.sum(m).alias(m) for m in measures])
    # At most 3 * bundles groups exceed a share of 1/bundles of some total.
    large = sized.filter("kind > 0")
    huge = large.filter("kind = 2").select(*group)
    cut = pieces.join(F.broadcast(huge), group, "left_semi")
    schema_cols = [*group, "piece", "bundle", *measures]
    none = F.lit(None)
    items = (
        small.select(*[none.cast("bigint").alias(c) for c in group], none.cast("int").alias("piece"), "bundle", *measures)
        .unionByName(large.filter("kind = 1").select(*group, none.cast("int").alias("piece"),
                                                    none.cast("bigint").alias("bundle"), *measures))
        .unionByName(cut.select(*group, F.col(piece).alias("piece"), none.cast("bigint").alias("bundle"), *measures))
        .select(*schema_cols)
    )
    # Bounded by bundles + 3 * bundles + n_shards * 3 * PIECES rows.
    listed = sorted(items.collect(), key=lambda r: tuple((x is not None, x) for x in r))
    vectors = np.array([[r[m] for m in measures] for r in listed], dtype=float).reshape(len(listed), len(measures))
    shards = place(vectors, n_shards) if listed else []

    of_bundle = [(int(r["bundle"]), int(s)) for r, s in zip(listed, shards, strict=True) if r["bundle"] is not None]
    of_group = [(*(r[c] for c in group), r["piece"], int(s)) for r, s in zip(listed, shards, strict=True) if r["bundle"] is None]
    bundle_map = spark.createDataFrame(of_bundle, f"`{p}bundle` bigint, `{p}small` int")
    group_schema = ", ".join(f"`{p}g{i}` bigint" for i in range(3))
    group_map = spark.createDataFrame(of_group, f"{group_schema}, `{p}gpiece` int, `{p}large` int")
    same = (F.col(hashed) == F.col(f"{p}g0")) & (F.col(crc) == F.col(f"{p}g1")) & (F.col(size) == F.col(f"{p}g2"))
    same = same & (F.col(f"{p}gpiece").isNull() | (F.col(f"{p}gpiece") == F.col(piece)))
    shard = f"{p}shard"
    placed = (
        rows.join(F.broadcast(bundle_map), bundle == F.col(f"{p}bundle"), "left")
        .join(F.broadcast(group_map), same, "left")
        .withColumn(shard, F.coalesce(f"{p}large", f"{p}small"))
    )
    part = f"{p}part"
    placed = placed.withColumn(part, F.pmod(F.xxhash64(F.lit("part"), F.col(doc_id), F.col(hashed)), F.lit(parts)))
    counts = placed.groupBy(shard, part).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(f"{p}offset"))
    inside = Window.partitionBy(shard, part).orderBy(doc_id, hashed)
    ranked = placed.withColumn(f"{p}rank", F.row_number().over(inside)).join(offsets, [shard, part])
    info = F.struct(
        F.col(size).alias("size"),
        F.col(crc).alias("text_crc32"),
        F.col(shard).alias("shard"),
        (F.col(f"{p}offset") + F.col(f"{p}rank") - 1).cast("bigint").alias("slot"),
    )
    return ranked.select(*[F.col(f"`{c}`") for c in docs.columns], info.alias(name)), name


def sharded(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """``docs`` with columns ``shard`` and ``slot`` (renamed if taken)."""
    out, name = assign_shards(docs, n_shards)
    shard, slot = free_name(docs, "shard"), free_name(docs, "slot")
    return out.withColumns({shard: F.col(name)["shard"], slot: F.col(name)["slot"]}).drop(name)
