"""Ranked lexical search by bag deduplication.

Documents are reduced to their bag: which terms of the items' vocabulary they
hold, how often, and the length factor ``m``.  Documents with equal bags and
equal ``m`` get equal scores for every item, so they form a class.  Classes are
found by hashing the bag and verified by comparing it whole (a grouping on hash
and bag).  Each class is scored once per item; an item's best classes are then
expanded to their members by ascending id.

The first ``k`` classes of an item by (score, smallest member) hold its first
``k`` documents: each of those classes has a member that stands before every
member of a later class.  So a task keeps ``k`` classes an item, and a class
lists ``k`` members at most, however many documents share the bag.

Where things run: texts become bags in Arrow batches and are read once; counts
(documents, terms, documents of a term), classes, members and ranks are Spark
aggregates, joins and windows; classes are scored in batches against blocks of
items, whose weights travel as a matrix of at most ``MAX_CELLS`` numbers.  The
driver holds the items' vocabulary (at most ``MAX_VOCABULARY`` hashes) and one
document count per term, nothing of the corpus.

Terms are told apart by a 64-bit hash of their bytes.  All scores are whole
numbers; they are computed in doubles where the largest possible sum stays below
2^53, else in 64-bit integers.

Defined cases: a null or empty text, or one without terms, counts as no
document and is never found; an item without terms, or with none that any
document holds, gets no row; texts are read whole, whatever their length; equal
scores are ordered by ascending id, null ids last; repeated documents are
documents of their own and each takes a rank; equal items (id and text) are one
item; empty tables give no rows.  The result has columns of its own, so names
in the inputs cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import separator_table, text_chunks, words_of
from tallyframe.operators.joins import checked_broadcast
from tallyframe.session import scratch_path

K = 20
# Bounds of what travels to every executor.
MAX_VOCABULARY = 4_000_000   # hashes of the items' terms
MAX_CELLS = 1 << 22          # numbers in the weights of a block of items
_CELLS_AT_ONCE = 1 << 21     # numbers in the part of a batch scored at once
_EXACT = 1 << 53

# ASCII apart from digits and letters separates terms.
SEPARATORS = separator_table([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

_BAG = "terms array<int>, tfs array<int>"


def _bag_batches(batches, vocabulary: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """``(id, n, terms, tfs)`` of each row (id, text); terms are places in the vocabulary, or hashes without one."""
    for batch in batches:
        for chunk in text_chunks(batch.column(1).cast(pa.string())):
            words = words_of(chunk, SEPARATORS, fold_case=True)
            hashes, doc = words.hash.view(np.int64), words.doc
            if vocabulary is not None:
                at = np.searchsorted(vocabulary, hashes)
                at[at == len(vocabulary)] = 0
                known = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
                hashes, doc = at[known], doc[known]
            order = np.lexsort((hashes, doc))
            hashes, doc = hashes[order], doc[order]
            first = np.ones(len(doc), bool)
            first[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
            starts = np.flatnonzero(first)
            tfs = np.diff(np.append(starts, len(doc)))
            offsets = pa.array(np.append(0, np.cumsum(np.bincount(doc[starts], minlength=len(chunk)))).astype(np.int32))
            kind = np.int64 if vocabulary is None else np.int32
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(chunk.first, len(chunk)), pa.array(words.counts.astype(np.int64)),
                pa.ListArray.from_arrays(offsets, pa.array(hashes[starts].astype(kind))),
                pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int32))),
            ], names=["id", "n", "terms", "tfs"])


def document_bags(docs: DataFrame, vocabulary: Broadcast, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n, terms, tfs)`` of every row: its terms with repeats, and the bag of its vocabulary terms in order."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _bag_batches(batches, vocabulary.value), f"id bigint, n bigint, {_BAG}")


def item_bags(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item, item_id, terms, tfs)`` of every different item that has terms, stored; terms are hashes."""
    spark = items.sparkSession
    path = scratch_path(spark, "search-items")
    distinct = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text")).distinct()
    numbered = scratch_path(spark, "search-numbered")
    distinct.select(F.monotonically_increasing_id().alias("id"), "item_id", "text").write.parquet(numbered)
    rows = spark.read.parquet(numbered)
    bags = rows.select("id", "text").mapInArrow(
        lambda batches: _bag_batches(batches, None), "id bigint, n bigint, terms array<bigint>, tfs array<int>")
    ids = rows.select(F.col("id").alias("item"), "item_id")
    bags.filter("n > 0").join(ids, F.col("id") == F.col("item")).select("item", "item_id", "terms", "tfs").write.parquet(path)
    return spark.read.parquet(path)


def weights(n_docs: int, df: dict[int, int]) -> dict[int, int]:
    """The weight of each term from the documents that hold it."""
    return {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}


def _blocks(items: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """Items in runs whose matrix of terms and items stays within MAX_CELLS."""
    block, terms = [], 0
    for item in items:
        if block and (terms + len(item[1])) * (len(block) + 1) > MAX_CELLS:
            yield block
            block, terms = [], 0
        block.append(item)
        terms += len(item[1])
    if block:
        yield block


class _Best:
    """The first k classes of every item so far, by descending score and ascending smallest member."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.rows = np.zeros((0, 5), np.int64)  # item, score, first_id, hash, m

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        at, item = np.nonzero(scores >= self.least)
        new = np.column_stack([item, scores[at, item], keys[at]])
        rows = np.concatenate([self.rows, new])
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        starts = np.searchsorted(rows[:, 0], np.arange(len(self.least) + 1))
        place = np.arange(len(rows)) - starts[rows[:, 0]]
        self.rows = rows[place < self.k]
        last = rows[place == self.k - 1]
        self.least[last[:, 0]] = last[:, 1]


def _score_batches(batches, block: dict, k: int) -> Iterator[pa.RecordBatch]:
    """The first k classes (first_id, hash, m, terms, tfs) of these batches for every item of the block."""
    terms, matrix, items = block["terms"], block["matrix"], block["items"]
    best = _Best(len(items), k)
    step = max(16, _CELLS_AT_ONCE // max(1, len(terms)))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            first_id, key, m = (part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            lists, counts = part.column(3), part.column(4)
            row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            term, tf = lists.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
            at = np.searchsorted(terms, term)
            at[at == len(terms)] = 0
            known = terms[at] == term
            row, at, tf = row[known], at[known], tf[known]
            gains = np.zeros((part.num_rows, len(terms)), matrix.dtype)
            gains[row, at] = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
            best.add((gains @ matrix).astype(np.int64), np.column_stack([first_id, key, m]))
    r = best.rows
    if len(r):
        yield pa.RecordBatch.from_arrays([pa.array(items[r[:, 0]]), *[pa.array(r[:, i]) for i in range(1, 5)]],
                                         names=["item", "score", "first_id", "hash", "m"])


def _block_weights(block, weight: dict[int, int]) -> dict:
    terms = np.unique(np.concatenate([t for _, t, _ in block]))
    cells = np.zeros((len(terms), len(block)), np.int64)
    w = np.array([weight.get(int(t), 0) for t in terms], np.int64)
    for j, (_, t, c) in enumerate(block):
        at = np.searchsorted(terms, t)
        cells[at, j] = c * w[at]
    # A term's part of a score stays below its weight times a million.
    exact = int(cells.sum(axis=0).max(initial=0)) * 1_000_000 < _EXACT
    return {"terms": terms.astype(np.int32), "matrix": cells.astype(np.float64) if exact else cells,
            "items": np.array([item for item, _, _ in block], np.int64)}


def search(
    docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` highest-scoring documents of every item, scores above 0.

    ``members`` says how many documents share the row's class.
    """
    spark = docs.sparkSession
    found = item_bags(items, item_id, item_text)
    hashes = found.select(F.explode("terms").alias("t")).distinct()
    if hashes.count() > MAX_VOCABULARY:
        raise ValueError(f"the items hold more than {MAX_VOCABULARY} different terms; search them in parts")
    vocabulary = np.sort(np.array([r["t"] for r in hashes.toLocalIterator()], np.int64))
    shared = spark.sparkContext.broadcast(vocabulary)

    path = scratch_path(spark, "search-bags")
    document_bags(docs, shared, doc_id, text).write.parquet(path)
    bags = spark.read.parquet(path)
    n_docs, n_terms = bags.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = bags.select(F.explode("terms").alias("t")).groupBy("t").count()
    weight = weights(n_docs, {r["t"]: r["count"] for r in df.toLocalIterator()})

    # Documents that hold a term of the vocabulary, under the hash of their bag.
    m = F.expr(f"75L + (25L * n * {n_docs}L) div {max(n_terms, 1)}L")
    keyed = bags.filter(F.size("terms") > 0).select("id", m.alias("m"), "terms", "tfs").withColumn(
        "hash", F.xxhash64("m", "terms", "tfs"))
    path = scratch_path(spark, "search-classes")
    last = (1 << 63) - 1
    keyed.groupBy("hash", "m", "terms", "tfs").agg(
        F.coalesce(F.min("id"), F.lit(last)).alias("first_id"), F.count(F.lit(1)).alias("members")).write.parquet(path)
    classes = spark.read.parquet(path)

    best = None
    rows = [(r["item"], np.searchsorted(vocabulary, np.array(r["terms"], np.int64)), np.array(r["tfs"], np.int64))
            for r in found.orderBy("item").toLocalIterator()]
    for block in _blocks(rows):
        sent = spark.sparkContext.broadcast(_block_weights(block, weight))
        part = classes.select("first_id", "hash", "m", "terms", "tfs").mapInArrow(
            lambda batches, sent=sent: _score_batches(batches, sent.value, k),
            "item bigint, score bigint, first_id bigint, hash bigint, m bigint")
        best = part if best is None else best.unionByName(part)
    if best is None:
        return found.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"),
                            F.lit(0).cast("bigint").alias("score"), F.lit(0).cast("bigint").alias("members")).limit(0)
    path = scratch_path(spark, "search-best")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first_id")
    best.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place").write.parquet(path)
    best = spark.read.parquet(path)

    # The classes found, with their bags; members have the same bag, not only the same hash.
    key = ["hash", "m", "first_id"]
    chosen = classes.join(best.select(*key).distinct(), key)
    bag = ["hash", "m", "terms", "tfs"]
    # Every map task keeps k rows of a class, so a class of very many documents moves few rows.
    wanted = checked_broadcast(best.select("hash").distinct())
    by_id = Window.partitionBy(*bag).orderBy(F.asc_nulls_last("id"))
    members = keyed.join(wanted, "hash", "left_semi").withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= k)
    ranked = members.join(chosen, bag).select(*key, "id", "members").join(best, key).withColumn(
        "rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    ).filter(F.col("rank") <= k)
    return ranked.join(found.select("item", "item_id"), "item").select(
        "item_id", "rank", F.col("id").alias("doc_id"), "score", "members")
