"""Lexical search against a plain scoring of every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tallyframe.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for t, c in df.items()}
    out = []
    for item_id, text in set(items):
        scored = []
        for d, b, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            s = sum(w[t] * ((1_000_000_000 * b[t]) // (1000 * b[t] + 12 * m)) for t in terms(text) if t in b)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        scored.sort(key=lambda x: x[:3])
        out += [(item_id, i + 1, x[3], -x[0]) for i, x in enumerate(scored[:k])]
    return sorted(out, key=repr)


def corpus(seed, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Alpha", "beta", "gÄmma", "42", "x-y", "the", "der", *[f"w{i}" for i in range(60)]])
    docs = []
    for i in range(n):
        text = " ".join(word() for _ in range(rng.choice([0, 1, 3, 10, 40])))
        docs += [(len(docs) + j, text) for j in range(rng.choice([1, 1, 1, 4]))]
    rng.shuffle(docs)
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 4, 12])))) for i in range(12)]
    return docs, items


def run(spark, docs, items, k=20):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    out = ls.search(d, i, k)
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in out.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs, items = corpus(seed)
    assert run(spark, docs, items) == brute(docs, items)


def test_a_hot_class_lists_its_smallest_ids_in_order(spark):
    docs = [(5000 - i, "one common bag") for i in range(3000)] + [(9000 + i, f"bag {i}") for i in range(40)]
    items = [(1, "common"), (2, "bag"), (3, "common common one")]
    got = run(spark, docs, items)
    assert got == brute(docs, items)
    assert [x[2] for x in sorted(got, key=lambda x: x[1]) if x[0] == 1] == list(range(2001, 2021))


def test_defined_cases(spark):
    docs = [(1, None), (2, ""), (3, "... !!"), (4, "word"), (None, "word"), (7, "word"), (7, "word"), (8, "long " * 30000 + "word"), (9, "other")]
    items = [(1, "word"), (1, "word"), (1, "other"), (2, None), (3, ""), (4, "absent"), (5, "word " * 500), (None, "long")]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "word")]) == []
    assert run(spark, [(1, "word")], []) == []


def test_clashing_columns_do_not_matter(spark, make_docs):
    docs = make_docs([(1, "alpha beta"), (2, "alpha")], clashing=True)
    items = spark.createDataFrame([(1, "alpha", "x", 3)], "item_id bigint, text string, score string, rank int")
    assert [(r["rank"], r["doc_id"]) for r in ls.search(docs, items).orderBy("rank").collect()] == [(1, 2), (2, 1)]


def test_items_are_scored_in_blocks_of_bounded_weights(spark, monkeypatch):
    docs, items = corpus(3, 60)
    monkeypatch.setattr(ls, "MAX_CELLS", 60)
    assert run(spark, docs, items) == brute(docs, items)


def test_scores_beyond_doubles_stay_whole_numbers(spark, monkeypatch):
    docs, items = corpus(4, 60)
    monkeypatch.setattr(ls, "_EXACT", 1)
    assert run(spark, docs, items) == brute(docs, items)
