"""Language identification by rank-order profiles.

A profile is the ``profile_size`` most frequent letter n-grams (1 to 3
letters, words padded with a blank) of a language, by rank.  A document's own
n-grams are ranked the same way over its whole text; its distance to a
language is the sum of how far each of its n-grams is out of place there, with
a fixed penalty for n-grams that the profile lacks.  The nearest profile wins.

Profiles are fitted on about ``docs_per_language`` labelled rows of each
language, chosen by the hash of the id (a documented bound); the counting
itself runs as Spark aggregations.  Every document is judged.

Defined cases: a null text or one without a letter is ``und`` with score 0;
ties between n-grams go to the smaller code, ties between languages to the
smaller name; repeated rows get equal answers; without any labelled row
everything is ``und``; an empty table gives an empty result.  A very long text
is ranked whole, in memory of about 60 bytes a code point.  The new column is
renamed if its name is taken; no column of the input changes.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import free_name, hash_fraction

PROFILE_SIZE = 1000
DOC_GRAMS = 400
DOCS_PER_LANGUAGE = 1500
UNKNOWN = "und"
_SALTS = 32

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _letters[0]


def gram_codes(text: str | None) -> np.ndarray:
    """Codes of all n-grams (n = 1, 2, 3) of the text's padded lower-case words.

    A code packs up to three code points of 21 bits; a blank is 0.  Repeats
    are kept.
    """
    if not text:
        return np.zeros(0, np.int64)
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    raw[~_letter_table()[raw]] = 0
    padded = np.zeros(len(raw) + 2, np.int64)
    padded[1:-1] = raw
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != 0) | (padded[:-1] != 0)
    c = padded[keep]
    if len(c) < 3:
        return np.zeros(0, np.int64)
    one = c[c != 0]
    two = (c[:-1] << 21) | c[1:]
    middle = c[1:-1] != 0
    three = ((c[:-2] << 42) | (c[1:-1] << 21) | c[2:])[middle]
    # The sizes are told apart by a top bit; a trigram starting with a blank
    # would else look like a bigram.
    return np.concatenate([one, two | (np.int64(1) << 62), three ^ np.int64(-(1 << 63))])


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first."""
    values, counts = np.unique(codes, return_counts=True)
    if len(values) > size:
        floor = np.partition(counts, len(counts) - size)[len(counts) - size]
        some = counts >= floor
        values, counts = values[some], counts[some]
    return values[np.lexsort((values, -counts))][:size]


class Profiles:
    """Ranks of the profile n-grams of every language."""

    def __init__(self, ranks: dict[str, list[int]], doc_grams: int = DOC_GRAMS, penalty: int = PROFILE_SIZE):
        self.languages = sorted(ranks)
        self.doc_grams, self.penalty = doc_grams, penalty
        self.grams = np.unique(np.array([g for gs in ranks.values() for g in gs], dtype=np.int64))
        self.rank = np.full((len(self.grams), len(self.languages)), -1, dtype=np.int64)
        for j, lang in enumerate(self.languages):
            self.rank[np.searchsorted(self.grams, np.array(ranks[lang], dtype=np.int64)), j] = np.arange(len(ranks[lang]))

    def distances(self, text: str | None) -> tuple[np.ndarray | None, int]:
        """Out-of-place distance to every language, and the document's number of ranked n-grams."""
        grams = ranked(gram_codes(text), self.doc_grams)
        if len(grams) == 0 or not self.languages:
            return None, 0
        place = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[place] == grams
        rank = self.rank[place[known]]
        # A document has fewer n-grams than a profile: its ranks are spread
        # over the profile's range before they are compared.
        spread = np.arange(len(grams), dtype=np.int64)
        out = np.abs(rank - spread[known][:, None])
        out = np.where(rank < 0, self.penalty, np.minimum(out, self.penalty))
        return out.sum(axis=0) + self.penalty * int((~known).sum()), len(grams)

    def predict(self, texts: pa.Array) -> pa.Array:
        langs, scores = [], np.zeros(len(texts))
        for i, text in enumerate(texts.to_pylist()):
            distance, n = self.distances(text)
            if distance is None:
                langs.append(UNKNOWN)
                continue
            best = int(np.argmin(distance))
            langs.append(self.languages[best])
            scores[i] = 1.0 - distance[best] / (n * self.penalty)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], names=["lang", "score"])


def _count_grams(batches):
    for batch in batches:
        for lang, group in batch.groupby("lang"):
            codes = np.concatenate([gram_codes(t) for t in group["text"]] or [np.zeros(0, np.int64)])
            values, counts = np.unique(codes, return_counts=True)
            yield pd.DataFrame({"lang": lang, "gram": values, "n": counts.astype(np.int64)})


def train(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    profile_size: int = PROFILE_SIZE, docs_per_language: int = DOCS_PER_LANGUAGE,
) -> Profiles:
    """Fit one profile per language on the labelled rows of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull())
    # One row per language.
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        return Profiles({})
    share = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, docs_per_language / r["n"])))])
    picked = rows.filter(hash_fraction("id") < share[F.col("lang")]).select("lang", "text")
    counts = picked.mapInPandas(_count_grams, "lang string, gram bigint, n bigint")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # Best of each salt first, then best of those: no window holds all n-grams
    # of a language.
    order = [F.col("n").desc(), F.col("gram")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(_SALTS))).orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    top = counts.withColumn("r", F.row_number().over(salted)).filter(F.col("r") <= profile_size)
    top = top.withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= profile_size)
    ranks: dict[str, list[int]] = {}
    # profile_size rows per language.
    for row in sorted(top.collect(), key=lambda r: (r["lang"], r["r"])):
        ranks.setdefault(row["lang"], []).append(row["gram"])
    return Profiles(ranks, penalty=profile_size)


def with_language(docs: DataFrame, profiles: Profiles, text: str = "text", name: str = "language") -> tuple[DataFrame, str]:
    """``docs`` with a struct ``{lang, score}`` predicted from the whole text alone; returns the frame and the struct's name."""
    name = free_name(docs, name)
    predict = F.arrow_udf(profiles.predict, "struct<lang: string, score: double>")
    return docs.withColumn(name, predict(F.col(text))), name
