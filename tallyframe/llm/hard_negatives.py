"""Hard-negative mining with cover trees over norm-augmented vectors.

Every vector gets one more component, ``sqrt(M^2 - |x|^2)`` with M the largest
norm, so all have norm M and the order by inner product with a query (whose
extra component is 0) is the order by distance.  Over these points a cover tree
is built: the children of a node lie more than a level's radius apart and cover
the node's points within that radius; radii shrink by ``BASE`` from level to
level.  Each node keeps its actual covering radius ``r``.  With ``s`` the
node's centre's score and ``d`` its distance, every point below it scores
within ``s +- |q| r`` and within ``s - d r - r^2/2 .. s + d r - r^2/2``.

A search has score windows.  The descent drops a node whose score interval meets
no window, or whose upper bound is below the scores already found for it;
leaves are then opened best bound first, in growing rounds, and their points are
scored exactly.

Where things run: the top of the tree is fitted on a bounded sample (``centres``,
at most ``MAX_CENTRES`` rows); every row goes to its nearest centre, branches of
more than ``CHUNK`` rows are split by a hash of the row (a vector shared by a
third of all rows too), and each part becomes one tree in a task of its own.
The trees are a stored table.  Queries are taken in blocks of about
``QUERY_BLOCK`` rows, which is what the driver and every executor hold; all
trees are searched for each block, every task keeps the first k of each window,
and a Spark window puts them together.

Defined cases: a row takes no part if its label or vector is null or a component
is null or not finite; shorter vectors count as padded with zeros (an empty one
is all zeros); rows equal in id, label and vector are one row, others with the
same id are rows of their own, but a row's "others" have another id; a row with
a null id is no anchor and stands last among equal scores; ties are ordered by
ascending id; an anchor without positives or negatives gives no row; an empty
table gives none.  The result has columns of its own, so names in the input
cannot clash.  Scores are exact while every squared norm is below 2^53; larger
vectors are refused with a ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.session import scratch_path

SCALE = 256
CHUNK = 2048            # rows of a tree
MAX_CENTRES = 4096      # bound of the sample that the top of the tree is fitted on
QUERY_BLOCK = 8192      # queries searched at once
BASE = 1.3              # ratio of the radii of two levels
LEAF = 16               # points of a node that is not divided further
N_POSITIVES, N_NEGATIVES = 5, 10
LOW_SHARE, HIGH_SHARE = 30, 90   # per cent of the positive's score
_NO_ID = (1 << 63) - 1
_QUERIES_AT_ONCE = 512

_TREE = ("ids array<bigint>, labels array<int>, points array<double>, level array<int>, parent array<int>, "
         "centre array<int>, radius array<double>, first array<int>, last array<int>")


def clean_rows(rows: DataFrame, row_id: str, label: str | Column, vector: str, scale: int = SCALE) -> DataFrame:
    """``(id, label, x)`` of the rows that take part; components are whole numbers, held as doubles."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    whole = F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("double"))
    out = rows.select(F.col(row_id).cast("bigint").alias("id"), label.cast("int").alias("label"), F.when(finite, whole).alias("x"))
    return out.filter(F.col("label").isNotNull() & F.col("x").isNotNull()).distinct()


def _matrix(lists: pa.ListArray, dim: int) -> np.ndarray:
    """Rows of lists as a matrix; shorter ones are padded with zeros."""
    n = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if len(n) and (n == dim).all():
        return values.reshape(len(n), dim)
    out = np.zeros((len(n), dim))
    out[np.repeat(np.arange(len(n)), n), np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)] = values
    return out


def _extra(x: np.ndarray, top: float) -> np.ndarray:
    """The component that gives every row of x the squared norm ``top``."""
    return np.sqrt(np.maximum(0.0, top - np.einsum("ij,ij->i", x, x)))


def _nearest(batches, centres: np.ndarray, dim: int, top: float) -> Iterator[pa.RecordBatch]:
    lifted = np.column_stack([centres, _extra(centres, top)])
    for batch in batches:
        x = _matrix(batch.column(2), dim)
        branch = np.argmax(np.column_stack([x, _extra(x, top)]) @ lifted.T, axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(branch.astype(np.int32))], names=["id", "label", "x", "branch"])


@dataclass
class _Node:
    level: int
    parent: int
    centre: int
    members: np.ndarray
    far: np.ndarray     # distance of each member to the centre


def cover_tree(points: np.ndarray) -> tuple[list[_Node], list[np.ndarray]]:
    """Nodes level by level, and the members of those that are leaves (None for others)."""
    def away(rows, centre):
        d = points[rows] - points[centre]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    everything = np.arange(len(points))
    nodes = [_Node(0, -1, 0, everything, away(everything, 0))]
    leaves: list = []
    at = 0
    while at < len(nodes):
        node = nodes[at]
        widest = node.far.max(initial=0.0)
        if len(node.members) <= LEAF or widest == 0.0:
            leaves.append(node.members)
            at += 1
            continue
        leaves.append(None)
        # The next level at which the node's own centre no longer covers all.
        radius = widest / BASE
        near, owner, centres = node.far.copy(), np.zeros(len(node.members), np.int64), [node.centre]
        while near.max() > radius:
            new = node.members[int(near.argmax())]
            d = away(node.members, new)
            closer = d < near
            near[closer], owner[closer] = d[closer], len(centres)
            centres.append(new)
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(1, len(centres)))
        for centre, rows in zip(centres, np.split(order, cuts)):
            nodes.append(_Node(node.level + 1, at, centre, node.members[rows], near[rows]))
        at += 1
    return nodes, leaves


def _build(table: pa.Table, dim: int, top: float) -> pa.Table:
    """One row: the cover tree of a group's rows, points in the order of its leaves."""
    x = _matrix(table["x"].combine_chunks(), dim)
    nodes, leaves = cover_tree(np.column_stack([x, _extra(x, top)]))
    held = [rows for rows in leaves if rows is not None]
    order = np.concatenate(held)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    ends = np.cumsum([0 if rows is None else len(rows) for rows in leaves])
    starts = ends - [0 if rows is None else len(rows) for rows in leaves]
    held_order = pa.array(order)
    columns = {
        "ids": table["id"].combine_chunks().take(held_order), "labels": table["label"].combine_chunks().take(held_order),
        "points": pa.array(x[order].ravel()), "level": pa.array([n.level for n in nodes], pa.int32()),
        "parent": pa.array([n.parent for n in nodes], pa.int32()), "centre": pa.array(place[[n.centre for n in nodes]]),
        "radius": pa.array([n.far.max(initial=0.0) for n in nodes], pa.float64()),
        "first": pa.array(starts.astype(np.int32)), "last": pa.array(ends.astype(np.int32)),
    }
    return pa.table({c: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for c, v in columns.items()})


@dataclass
class Index:
    """A stored table of cover trees, with the figures that searches need."""

    trees: DataFrame
    dim: int
    top: float  # largest squared norm


def build_index(rows: DataFrame, chunk: int = CHUNK, max_centres: int = MAX_CENTRES) -> Index:
    """Cover trees over all of ``rows`` (id, label, x), as from ``clean_rows``."""
    spark = rows.sparkSession
    squared = F.aggregate("x", F.lit(0.0), lambda acc, c: acc + c * c)
    n, dim, top = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0)), F.coalesce(F.max(squared), F.lit(0.0))).first()
    if top >= 1 << 53:
        raise ValueError("vectors are too long for exact scores: a squared norm reaches 2^53")
    mark = F.xxhash64("id", "label", "x")
    wanted = min(max_centres, -(-n // chunk))
    sample = rows.select("x", mark.alias("mark")).orderBy("mark").limit(wanted).collect()
    centres = np.zeros((max(1, len(sample)), dim))
    for i, r in enumerate(sample):
        centres[i, :len(r["x"])] = r["x"]
    centres = np.unique(centres, axis=0)
    placed = rows.mapInArrow(lambda batches: _nearest(batches, centres, dim, top), "id bigint, label int, x array<double>, branch int")
    path = scratch_path(spark, "negatives-placed")
    placed.write.parquet(path)
    placed = spark.read.parquet(path)
    # At most one row per centre.
    parts = {r["branch"]: -(-r["count"] // chunk) for r in placed.groupBy("branch").count().collect()}
    split = F.coalesce(*[F.when(F.col("branch").isin(list(b)), n) for n, b in _by_value(parts).items()], F.lit(1))
    groups = placed.withColumn("part", F.pmod(mark, split))
    trees = groups.groupBy("branch", "part").applyInArrow(lambda table: _build(table, dim, top), _TREE)
    path = scratch_path(spark, "negatives-trees")
    trees.write.parquet(path)
    return Index(spark.read.parquet(path), dim, top)


def _by_value(parts: dict[int, int]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for key, n in parts.items():
        out.setdefault(n, []).append(key)
    return out


class _Found:
    """The first k points of every query and window so far, by descending score and ascending id."""

    def __init__(self, low: np.ndarray, k: int):
        self.k, self.windows = k, low.shape[1]
        self.least = low.astype(np.float64).copy()   # lowest score still wanted
        self.rows = np.zeros((0, 3), np.int64)       # query * windows + window, score, id

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(slot) == 0:
            return
        rows = np.concatenate([self.rows, np.column_stack([slot, score, ids])])
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        _, starts, counts = np.unique(rows[:, 0], return_index=True, return_counts=True)
        place = np.arange(len(rows)) - np.repeat(starts, counts)
        self.rows = rows[place < self.k]
        last = rows[place == self.k - 1]
        flat = self.least.reshape(-1)
        flat[last[:, 0]] = np.maximum(flat[last[:, 0]], last[:, 1])


def _intervals(q, q_norm, top, centres, radius):
    """Lowest and highest score that a point below each node can have, with room for rounding."""
    s = q @ centres.T
    d = np.sqrt(np.maximum(0.0, q_norm[:, None] ** 2 + top - 2 * s))
    by_norm, half = q_norm[:, None] * radius, radius * radius / 2
    high = np.where(radius < d, np.minimum(s + by_norm, s + d * radius - half), s + by_norm)
    low = np.maximum(s - by_norm, s - d * radius - half)
    room = 0.5 + top * 2.0 ** -40
    return low - room, high + room


def search_tree(tree: dict, q: np.ndarray, label: np.ndarray, q_id: np.ndarray, same: bool,
                high: np.ndarray, top: float, found: _Found) -> int:
    """Add the points of one tree that belong to the queries' windows; returns how many points were scored.

    ``high``: the windows' upper ends (query, window); the lower ones are
    ``found.least``.  ``same``: points need the query's label, else another.
    """
    points, level, parent = tree["points"], tree["level"], tree["parent"]
    nq, q_norm = len(q), np.sqrt(np.einsum("ij,ij->i", q, q))
    is_leaf = tree["last"] > tree["first"]
    bound = np.full((nq, len(level)), -np.inf)
    wanted = lambda lo, hi: ((hi[:, :, None] >= found.least[:, None, :]) & (lo[:, :, None] <= high[:, None, :])).any(axis=2)
    for at in range(int(level.max()) + 1):
        nodes = np.flatnonzero(level == at)
        open_ = np.isfinite(bound[:, parent[nodes]]) if at else np.ones((nq, len(nodes)), bool)
        some = open_.any(axis=0)
        nodes, open_ = nodes[some], open_[:, some]
        if len(nodes) == 0:
            break
        lo, hi = _intervals(q, q_norm, top, points[tree["centre"][nodes]], tree["radius"][nodes])
        bound[:, nodes] = np.where(open_ & wanted(lo, hi), hi, -np.inf)
    leaves = np.flatnonzero(is_leaf)
    bound = bound[:, leaves]
    first, size = tree["first"][leaves], (tree["last"] - tree["first"])[leaves]
    order = np.argsort(-bound, axis=1)
    ranked = np.take_along_axis(bound, order, axis=1)
    scored, begin, width = 0, 0, 4
    while begin < len(leaves):
        # A leaf whose bound fell below what is wanted by now stays closed; so do all after it.
        take = ranked[:, begin:begin + width] >= found.least.min(axis=1)[:, None]
        take &= np.isfinite(ranked[:, begin:begin + width])
        row, col = np.nonzero(take)
        if len(row) == 0:
            break
        leaf = order[row, begin + col]
        row = np.repeat(row, size[leaf])
        n = size[leaf]
        point = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[leaf], n)
        if len(row) * 8 > nq * len(points):
            score = (q @ points.T)[row, point]
        else:
            score = np.concatenate([np.einsum("ij,ij->i", q[row[i:i + 65536]], points[point[i:i + 65536]])
                                    for i in range(0, len(row), 65536)])
        scored += len(row)
        fits = ((tree["labels"][point] == label[row]) == same) & (tree["ids"][point] != q_id[row])
        row, point, score = row[fits], point[fits], score[fits]
        inside = (score[:, None] >= found.least[row]) & (score[:, None] <= high[row])
        pair, window = np.nonzero(inside)
        found.add(row[pair] * found.windows + window, score[pair].astype(np.int64), tree["ids"][point[pair]])
        begin, width = begin + width, width * 2
    return scored


def _trees(batches, dim: int) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            tree = {name: batch.column(name)[i].values for name in batch.schema.names}
            ids = tree["ids"].fill_null(_NO_ID)
            tree = {name: v.to_numpy(zero_copy_only=False) for name, v in {**tree, "ids": ids}.items()}
            tree["points"] = tree["points"].reshape(len(tree["ids"]), dim)
            yield tree


def _search_batches(batches, block: dict, same: bool, k: int, dim: int, top: float) -> Iterator[pa.RecordBatch]:
    """The first k points of these trees for every query and window: (query, window, id, score)."""
    parts = [slice(i, i + _QUERIES_AT_ONCE) for i in range(0, len(block["ids"]), _QUERIES_AT_ONCE)]
    found = [_Found(block["low"][p], k) for p in parts]
    for tree in _trees(batches, dim):
        for p, f in zip(parts, found):
            search_tree(tree, block["x"][p], block["labels"][p], block["ids"][p], same, block["high"][p], top, f)
    for p, f in zip(parts, found):
        if len(f.rows):
            slot, score, ids = f.rows.T
            yield pa.RecordBatch.from_arrays([
                pa.array((slot // f.windows + p.start).astype(np.int32)), pa.array((slot % f.windows).astype(np.int32)),
                pa.array(ids, mask=ids == _NO_ID), pa.array(score)], names=["query", "window", "id", "score"])


def _search(index: Index, block: dict, same: bool, k: int) -> DataFrame:
    """``(query, window, id, score, place)``: the first ``k`` points of every query and window over all trees."""
    sent = index.trees.sparkSession.sparkContext.broadcast(block)
    dim, top = index.dim, index.top
    rows = index.trees.mapInArrow(lambda batches: _search_batches(batches, sent.value, same, k, dim, top),
                                  "query int, window int, id bigint, score bigint")
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _block(rows, dim: int) -> dict:
    x = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        x[i, :len(r["x"])] = r["x"]
    return {"ids": np.array([r["id"] for r in rows], np.int64), "labels": np.array([r["label"] for r in rows], np.int64), "x": x}


def mine(rows: DataFrame, anchors: DataFrame, n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES,
         low_share: int = LOW_SHARE, high_share: int = HIGH_SHARE, query_block: int = QUERY_BLOCK,
         chunk: int = CHUNK, max_centres: int = MAX_CENTRES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` and ``anchors``: (id, label, x) from ``clean_rows``.  An anchor's
    positives are its first other rows of the same label; each positive's
    negatives are the first rows of another label whose score lies between the
    two shares (per cent) of the positive's.
    """
    spark = rows.sparkSession
    index = build_index(rows, chunk, max_centres)
    anchors = anchors.filter(F.col("id").isNotNull())
    path = scratch_path(spark, "negatives-anchors")
    anchors.write.parquet(path)
    anchors = spark.read.parquet(path)
    n_blocks = max(1, -(-anchors.count() // query_block))
    out = scratch_path(spark, "negatives")
    for b in range(n_blocks):
        of_block = F.pmod(F.xxhash64(F.lit("block"), "id", "label", "x"), F.lit(n_blocks)) == b
        block = _block(anchors.filter(of_block).collect(), index.dim)  # about query_block rows
        n = len(block["ids"])
        block["low"], block["high"] = np.full((n, 1), -np.inf), np.full((n, 1), np.inf)
        positives = _search(index, block, True, n_positives).collect()  # n_positives a query at most
        score, pos_id = np.zeros((n, n_positives), np.int64), np.full((n, n_positives), _NO_ID)
        low, high = np.full((n, n_positives), np.inf), np.full((n, n_positives), -np.inf)
        for r in positives:
            q, w, s = r["query"], r["place"] - 1, r["score"]
            score[q, w], pos_id[q, w] = s, _NO_ID if r["id"] is None else r["id"]
            low[q, w], high[q, w] = -(-low_share * s // 100), high_share * s // 100
        block["low"], block["high"] = low, high
        negatives = _search(index, block, False, n_negatives)
        names = spark.createDataFrame(
            [(q, w, int(block["ids"][q]), None if pos_id[q, w] == _NO_ID else int(pos_id[q, w]), int(score[q, w]))
             for q in range(n) for w in range(n_positives) if np.isfinite(high[q, w])],
            "query int, window int, anchor_id bigint, positive_id bigint, positive_score bigint")
        negatives.join(names, ["query", "window"]).select(
            "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(out)
    return spark.read.parquet(out)
