"""N-gram Jaccard join by filtering under several global token orders.

A document is the set of its distinct SHINGLE-word shingles.  Two sets of a
Jaccard similarity of at least ``T`` (3/4) miss at most a quarter of either
set, so under *any* global order of the tokens their prefixes share a token.
Different orders catch different accidental overlaps, and only what passes
all of them is verified:

1. Order by hash, with a long prefix: all tokens below the ``LOW`` quantile of
   the hash.  Both documents of a link keep or drop a shared token alike, so a
   document passes only if all but a quarter of its size of these tokens occur
   in another document too.  This removes most documents from the join.
2. Order by frequency among the documents left, rare tokens first, with the
   shortest prefix: tokens no other document has come first, passages that
   very many documents share come last.  Documents are candidates if they
   share a token that stands early enough in both for the overlap that their
   two sizes demand.
3. Before the sets are compared, a candidate pair must also share enough of
   the long hash prefix of each, and a token of the prefix under the reversed
   hash order.

Documents with equal sets are one node.  Links are wanted for the classes they
form, so pairs already connected are not compared again.  Each bucket of a
prefix token is led by the node where the token stands earliest, the one with
the fewest tokens of its own; each node is first compared with the lead that it
shares most buckets with, the links are contracted to components, and then
every candidate pair across components is compared.  A large group of near copies thus costs about one comparison per
member, and no link between different components is lost.

Defined cases: a null or empty text, or one without words, has an empty set,
links with nothing and is its own component; a text of fewer than SHINGLE
words is one shingle; repeated rows are one node; a null id never names a
component (null only if every id in it is null); an empty table gives an empty
result.  Tokens and nodes are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import (
    Words,
    distinct,
    free_prefix,
    gram_hashes,
    mix64,
    separator_table,
    text_chunks,
    words_of,
)
from tallyframe.llm.components import components
from tallyframe.operators.joins import checked_broadcast
from tallyframe.session import scratch_path

SHINGLE = 5
LOW = 0.35
_LOW_LIMIT = np.uint64(int(LOW * 2.0**64))
_SEED = np.uint64(0x5851F42D4C957F2D)
# Links: 100 * shared >= 75 * union, that is 4 * shared >= 3 * union.


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of every text, in the order of a second hash (the hash order)."""
    space = separator_table()
    for chunk in text_chunks(texts):
        words = words_of(chunk, space, fold_case=True)
        grams, first = gram_hashes(words, SHINGLE)
        cut = np.searchsorted(words.doc[first], np.arange(len(chunk) + 1))
        word_cut = np.searchsorted(words.doc, np.arange(len(chunk) + 1))
        order_key = mix64(grams ^ _SEED)
        for i in range(len(chunk)):
            key = order_key[cut[i]:cut[i + 1]]
            n_words = word_cut[i + 1] - word_cut[i]
            if 0 < n_words < SHINGLE:
                own = Words(np.zeros(n_words, np.int64), words.start, words.end, words.hash[word_cut[i]:word_cut[i + 1]], words.counts)
                key = mix64(gram_hashes(own, int(n_words))[0] ^ _SEED)
            # The second hash is a bijection, so it serves as the token itself.
            yield distinct(key)


def _node(tokens: np.ndarray) -> int:
    """One number for a set, whatever the order of its tokens."""
    total = np.array([mix64(tokens + np.uint64(1)).sum(dtype=np.uint64) + np.uint64(len(tokens))], np.uint64)
    return int(mix64(total).view(np.int64)[0])


def _describe(texts: pa.Array) -> pa.Array:
    """Size, node and number of low tokens of every text's set; the node of an empty set is null."""
    n, node, low = [], [], []
    for tokens in _sets(texts):
        n.append(len(tokens))
        node.append(_node(tokens) if len(tokens) else None)
        low.append(int(np.searchsorted(tokens, _LOW_LIMIT)))
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(low, pa.int64())], names=["n", "node", "low"])


# Texts whose tokens a worker holds at once.
SLICE = 2500


def _slices(batches) -> Iterator[pa.Array]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.column(0).slice(at, SLICE)
        pa.default_memory_pool().release_unused()


def _low_tokens(batches):
    """Rows (token, node, local) of the low tokens of every slice of a batch.

    A token that two sets of the slice hold is sent once, without a node: it
    is known to be shared, and each holder counts it in one row of its own
    (local >= 0).  So a token of very many documents costs a row per slice.
    """
    for texts in _slices(batches):
        tokens, nodes, seen = [], [], set()
        for s in _sets(texts):
            low = s[:np.searchsorted(s, _LOW_LIMIT)]
            if len(s) == 0 or (node := _node(s)) in seen:
                continue
            seen.add(node)
            tokens.append(low)
            nodes.append(np.full(len(low), node, np.int64))
        if not tokens:
            continue
        token, node = np.concatenate(tokens), np.concatenate(nodes)
        if len(token) == 0:
            continue
        order = np.argsort(token, kind="stable")
        token, node = token[order], node[order]
        same = np.concatenate([token[1:] == token[:-1], [False]])
        shared = same.copy()
        shared[1:] |= same[:-1]
        once = token[shared & ~same]            # last of each run of equal tokens
        holders, held = np.unique(node[shared], return_counts=True)
        alone = ~shared
        info = mix64(holders.view(np.uint64) ^ _SEED)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([token[alone], once, info]).view(np.int64)),
            pa.array(np.concatenate([node[alone], np.zeros(len(once), np.int64), holders]),
                     mask=np.concatenate([np.zeros(alone.sum(), bool), np.ones(len(once), bool), np.zeros(len(holders), bool)])),
            pa.array(np.concatenate([np.full(alone.sum() + len(once), -1), held]).astype(np.int32)),
        ], names=["token", "node", "local"])


def _token_lists(texts: pa.Array) -> pa.Array:
    """The sets themselves, as one list array."""
    sets = [s.view(np.int64) for s in _sets(texts)]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int32)
    values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    del sets
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _misses(n: Column) -> Column:
    """Most tokens of a set of size n that a linked set can lack."""
    return n - F.floor((3 * n + 3) / 4)


def _passing_nodes(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes that pass the hash order's filter."""
    rows = docs.mapInArrow(_low_tokens, "token bigint, node bigint, local int")
    of_token = Window.partitionBy("token")
    shared = F.max(F.col("node").isNull()).over(of_token) | (F.min("node").over(of_token) != F.max("node").over(of_token))
    found = rows.withColumn("shared", shared).filter(F.col("node").isNotNull())
    counted = found.withColumn("one", F.when(F.col("local") >= 0, F.col("local")).otherwise(F.col("shared").cast("int")))
    per_node = counted.groupBy("node").agg(F.sum("one").alias("found"))
    judged = classes.join(per_node, "node", "left")
    return judged.filter(F.coalesce("found", F.lit(0)) >= F.col("low") - _misses(F.col("n"))).drop("found", "low")


def _prefix_rows(sets: DataFrame) -> DataFrame:
    """``(token, node, n, place)``: the shared tokens in the rare-first prefix of every set that can still link.

    ``place`` counts from 1 and includes the tokens nobody else has, which
    come first.
    """
    tokens = sets.select("node", "n", F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = tokens.join(counts, "token")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("df", "token"))
    held = F.count(F.lit(1)).over(Window.partitionBy("node"))
    placed = shared.withColumn("place", rank + F.col("n") - held)
    return placed.filter(F.col("place") <= _misses(F.col("n")) + 1).select("token", "node", "n", "place")


def _early_enough(n: str, place: str, m: str, other_place: str) -> Column:
    """Whether a token at these places can be the first shared one of two linked sets of sizes n and m.

    A link shares at least 3/7 of both sizes together, and nothing before its
    first shared token.
    """
    need = 3 * (F.col(n) + F.col(m))
    return (7 * (F.col(n) - F.col(place) + 1) >= need) & (7 * (F.col(m) - F.col(other_place) + 1) >= need)


def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether the two sets of each row link; filters of the orders first, then the sets."""
    out = np.zeros(len(a), bool)
    a, b = a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a, b.combine_chunks() if isinstance(b, pa.ChunkedArray) else b
    for i in range(len(a)):
        x = a[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
        y = b[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
        out[i] = sets_link(x, y)
    return pa.array(out)


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def sets_link(x: np.ndarray, y: np.ndarray) -> bool:
    """Exact test of two sets in hash order."""
    n, m = len(x), len(y)
    if 4 * min(n, m) < 3 * max(n, m):
        return False
    miss_x, miss_y = n - (3 * n + 3) // 4, m - (3 * m + 3) // 4
    low_x, low_y = x[:np.searchsorted(x, _LOW_LIMIT)], y[:np.searchsorted(y, _LOW_LIMIT)]
    if _shared(low_x, low_y) < max(len(low_x) - miss_x, len(low_y) - miss_y):
        return False
    if _shared(x[n - miss_x - 1:], y[m - miss_y - 1:]) == 0:
        return False
    shared = _shared(x, y)
    return 4 * shared >= 3 * (n + m - shared)


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("of_b"))
    # One side at a time, where the sets are read; sets meet by the key a.
    firsts = left.join(checked_broadcast(pairs.select("a").distinct()), "a", "left_semi")
    seconds = right.join(checked_broadcast(pairs), "b")
    link = F.arrow_udf(_linked, "boolean")
    return seconds.join(firsts, "a").filter(link("of_a", "of_b")).select("a", "b")


def _saved(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage is cut, nothing is computed twice."""
    path = scratch_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def find_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(id, hash, n, node)`` of every row, and ``(node, component)`` of every non-empty set.

    ``hash`` is the text's xxhash64; with the id it finds the row again.
    """
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    describe = F.arrow_udf(_describe, "struct<n: bigint, node: bigint, low: bigint>")
    described = texts.select("id", F.xxhash64("text").alias("hash"), describe("text").alias("d"))
    rows = _saved(described.select("id", "hash", "d.n", "d.node", "d.low"), "jaccard-nodes")
    classes = rows.filter("n > 0").groupBy("node", "n", "low").agg(F.min("id").alias("first"))

    passing = _passing_nodes(texts.select("text"), classes).select("node", "n", "first").checkpoint()
    full = F.arrow_udf(_token_lists, "array<bigint>")
    # The row that speaks for each class, found again by id and text hash.
    mine = rows.join(passing.withColumnRenamed("node", "of"), (F.col("node") == F.col("of")) & F.col("id").eqNullSafe(F.col("first")))
    mine = mine.groupBy("of").agg(F.first("id").alias("its_id"), F.min("hash").alias("its_hash"))
    mine = mine.select(F.col("of").alias("node"), "its_id", "its_hash")
    same = F.col("id").eqNullSafe(F.col("its_id")) & (F.xxhash64("text") == F.col("its_hash"))
    sets = texts.join(checked_broadcast(mine), same).select("node", full("text").alias("tokens"))
    sets = _saved(sets.withColumn("n", F.size("tokens").cast("bigint")), "jaccard-sets")

    prefix = _prefix_rows(sets).distinct().checkpoint()
    lead = prefix.groupBy("token").agg(F.min(F.struct("place", "node", "n")).alias("l"), F.count(F.lit(1)).alias("members"))
    lead = lead.filter("members > 1").select(
        "token", F.col("l.node").alias("lead"), F.col("l.place").alias("lead_place"), F.col("l.n").alias("lead_n"))
    star = prefix.join(lead, "token").filter((F.col("node") != F.col("lead")) & _early_enough("n", "place", "lead_n", "lead_place"))
    star = star.groupBy("node", "lead").agg(F.count(F.lit(1)).alias("common"))
    best = Window.partitionBy("node").orderBy(F.col("common").desc(), "lead")
    first_pairs = star.withColumn("r", F.row_number().over(best)).filter("r = 1").select(
        F.col("lead").alias("a"), F.col("node").alias("b")).checkpoint()
    links = _verify(first_pairs, sets).checkpoint()
    roots = components(links)

    # What is left: pairs of a bucket that lie in different components.  The
    # members outside the component of the bucket's lead meet all others.
    placed = prefix.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).checkpoint()
    main = placed.join(lead, "token").groupBy("token").agg(
        F.min(F.when(F.col("node") == F.col("lead"), F.col("root"))).alias("main"),
        F.min("root").alias("lo"), F.max("root").alias("hi"),
    ).filter("lo <> hi").select("token", "main")
    mixed = placed.join(main, "token")
    outside = mixed.filter("root <> main").select(
        "token", F.col("node").alias("x"), F.col("root").alias("x_root"), F.col("n").alias("x_n"), F.col("place").alias("x_place"))
    meet = (F.col("x_root") != F.col("root")) & ((F.col("root") == F.col("main")) | (F.col("x") < F.col("node")))
    meet = meet & _early_enough("n", "place", "x_n", "x_place")
    across = outside.join(mixed, "token").filter(meet).select(
        F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
    tried = first_pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    across = across.join(tried, ["a", "b"], "left_anti").checkpoint()
    more = _verify(across, sets)

    all_links = links.unionByName(more).checkpoint()
    roots = components(all_links)
    named = classes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "first")
    least = named.groupBy("root").agg(F.min("first").alias("component"))
    return rows.select("id", "hash", "n", "node"), named.join(least, "root").select("node", "component")


def component_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, hash, n_shingles, component_id)`` of every row of ``docs``."""
    rows, component = find_components(docs, doc_id, text)
    joined = rows.join(component, "node", "left")
    return joined.select("id", "hash", F.col("n").alias("n_shingles"),
                         F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component_id"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, the one that names it; texts without words all stay.

    Rows equal in id and text are one row; so are equal texts without an id
    where no row of the component has one.
    """
    rows = component_rows(docs, doc_id, text).checkpoint()
    p = free_prefix(docs, "_jac_")
    key = [F.col("id").alias(f"{p}id"), F.col("hash").alias(f"{p}hash")]
    keyed = docs.withColumn(f"{p}text", F.xxhash64(F.col(text)))
    same = F.col(doc_id).eqNullSafe(F.col(f"{p}id")) & F.col(f"{p}text").eqNullSafe(F.col(f"{p}hash"))
    # The rows that go are the fewer; where they are proven small the texts are not shuffled.
    gone = rows.filter(~F.col("component_id").eqNullSafe(F.col("id"))).select(*key).distinct()
    kept = keyed.join(checked_broadcast(gone), same, "left_anti")
    twice = rows.filter("n_shingles > 0").groupBy("id", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key)
    if not twice.isEmpty():
        again = checked_broadcast(twice.checkpoint())
        once = kept.join(again, same, "left_semi").dropDuplicates([doc_id, f"{p}text"])
        kept = kept.join(again, same, "left_anti").unionByName(once)
    return kept.drop(f"{p}text")
