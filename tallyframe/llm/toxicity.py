"""Toxicity: FTRL-proximal logistic regression over hashed word grams.

Features of a text: its distinct words, word pairs and pairs with one word
between them (skip-grams), each hashed to ``2**BITS`` slots.  FTRL-proximal
keeps a learning rate per slot and an L1 term, so most weights are exactly
zero and the model is a short list of (slot, weight).

Training uses labelled rows only, at most about ``max_rows`` of them (chosen
by the hash of the id, a documented bound).  They are dealt to groups of about
``ROWS_PER_SHARD`` rows by that hash; each group runs its own passes in a task
and the weights are averaged.  The averaged nonzero weights (at most
``2**BITS``) are sent with the scoring function.

Defined cases: a null or empty text, or one without words, has no features and
scores the model's base rate; rows with a null id, or a label that is null or
not 0 or 1 (``n/a``), are not trained on; an empty table gives an empty result;
repeated rows score alike; with no usable labels, or only one class, every
score is the (smoothed) base rate.  Only the text enters a score.  A very long
text is scored whole, in memory of about 40 bytes a byte.  The new column is
renamed if its name is taken; no column of the input changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import distinct, free_name, hash_fraction, mix64, separator_table, text_chunks, words_of
from tallyframe.operators.joins import checked_broadcast

BITS = 20
ALPHA, BETA, L2 = 1.5, 1.0, 0.1
# The L1 term grows as the noise of a slot's gradient sum does, with the root of the rows.
L1_PER_ROOT_ROW = 0.08
EPOCHS = 8
# A slot is learned from its MIN_SEEN-th text on (fewer for small samples), so
# words of a single text cannot stand in for its label.
MIN_SEEN = 4
MAX_ROWS = 24_000
ROWS_PER_SHARD = 9_000
# Everything but ASCII letters and digits and the bytes of non-ASCII characters separates words.
BREAKS = [b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)]


def _features(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct feature slots of every text, in order."""
    breaks = separator_table(BREAKS)
    mask = np.uint64((1 << BITS) - 1)
    for chunk in text_chunks(texts):
        w = words_of(chunk, breaks, fold_case=True)
        grams = [(w.hash, w.doc)]
        for gap, salt in ((1, 0xA24BAED4963EE407), (2, 0x9FB21C651E98DF25)):
            if len(w.hash) > gap:
                same = w.doc[:-gap] == w.doc[gap:]
                pair = mix64(w.hash[:-gap] * np.uint64(salt) + w.hash[gap:])
                grams.append((pair[same], w.doc[:-gap][same]))
        slots = np.concatenate([g & mask for g, _ in grams]).astype(np.int64)
        docs = np.concatenate([d for _, d in grams])
        both = distinct((docs.astype(np.int64) << BITS) | slots)
        cut = np.searchsorted(both, np.arange(len(chunk) + 1, dtype=np.int64) << BITS)
        both &= (1 << BITS) - 1
        for i in range(len(chunk)):
            yield both[cut[i]:cut[i + 1]]


def _ftrl(texts: list, labels: np.ndarray, base: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passes of FTRL-proximal over one group of rows: nonzero slots, weights and squared gradient sums."""
    rows = [f.astype(np.int32) for f in _features(pa.array(texts, pa.large_string()))]
    seen = np.zeros(1 << BITS, np.int32)
    for x in rows:
        seen[x] += 1
    least = max(2, min(MIN_SEEN, len(rows) // 2000))
    rows = [x[seen[x] >= least] for x in rows]
    l1 = L1_PER_ROOT_ROW * len(rows) ** 0.5
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _ in range(EPOCHS):
        for x, y in zip(rows, labels, strict=True):
            w = _weights(z[x], n[x], l1)
            p = 1.0 / (1.0 + np.exp(-np.clip(base + w.sum(), -35, 35)))
            g = p - y
            sigma = (np.sqrt(n[x] + g * g) - np.sqrt(n[x])) / ALPHA
            z[x] += g - sigma * w
            n[x] += g * g
    slots = np.flatnonzero(n > 0)
    weights = _weights(z[slots], n[slots], l1)
    return slots, weights, n[slots]


def _weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


class Model:
    """Base log-odds and the nonzero weights by slot."""

    def __init__(self, base: float, slots: np.ndarray, weights: np.ndarray):
        order = np.argsort(slots)
        self.base, self.slots, self.weights = base, slots[order], weights[order]

    def scores(self, texts: pa.Array) -> pa.Array:
        table = np.zeros(1 << BITS)
        table[self.slots] = self.weights
        raw = np.fromiter((table[x].sum() for x in _features(texts)), dtype=float, count=len(texts))
        return pa.array(1.0 / (1.0 + np.exp(-np.clip(self.base + raw, -35, 35))))


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    max_rows: int = MAX_ROWS,
) -> Model:
    """Fit on the rows of ``docs`` that ``labels`` marks 0 or 1."""
    usable = labels.select(F.col(doc_id).alias("id"), F.col(label).try_cast("int").alias("y")).filter(
        F.col("id").isNotNull() & F.col("y").isin(0, 1)
    ).groupBy("id").agg(F.max("y").alias("y"))
    total = usable.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).first()
    n, positive = int(total["n"]), int(total["y"] or 0)
    rate = (positive + 1.0) / (n + 2.0)
    base = float(np.log(rate / (1.0 - rate)))
    if positive == 0 or positive == n:
        return Model(base, np.zeros(0, np.int64), np.zeros(0))
    usable = usable.withColumn("u", hash_fraction("id")).filter(F.col("u") < min(1.0, max_rows / n))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # About ROWS_PER_SHARD rows a group, whatever max_rows; the id fixes the group.
    shards = -(-min(n, max_rows) // ROWS_PER_SHARD)
    rows = texts.join(checked_broadcast(usable), "id").withColumn("shard", (F.col("u") * 1e9).cast("bigint") % shards)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["u", "id"], kind="stable")
        slots, weights, seen = _ftrl(list(group["text"]), group["y"].to_numpy(float), base)
        return pd.DataFrame({"slot": slots, "weight": weights, "seen": seen})

    fitted = rows.groupBy("shard").applyInPandas(fit, "slot bigint, weight double, seen double")
    # A group's say in a slot is the gradient it has seen there.  At most
    # 2**BITS slots come back, whatever the size of the corpus.
    mean = fitted.groupBy("slot").agg((F.sum(F.col("weight") * F.col("seen")) / F.sum("seen")).alias("weight"))
    nonzero = sorted(mean.filter("weight <> 0").collect(), key=lambda r: r["slot"])
    return Model(base, np.array([r["slot"] for r in nonzero], np.int64), np.array([r["weight"] for r in nonzero]))


def with_score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> tuple[DataFrame, str]:
    """``docs`` with the model's probability for every whole text; returns the frame and the new column's name."""
    name = free_name(docs, name)
    score = F.arrow_udf(model.scores, "double")
    return docs.withColumn(name, score(F.col(text))), name
