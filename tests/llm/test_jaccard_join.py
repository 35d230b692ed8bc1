"""The Jaccard join against all pairs, with hot groups."""

from __future__ import annotations

import random
import re
from itertools import combinations

import pytest

from tallyframe.llm import jaccard_join as j
from tallyframe.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        s, t = sets[a], sets[b]
        if s and t and 100 * len(s & t) >= 75 * len(s | t):
            parent[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        ids = [x for x in (least.get(r), doc_id) if x is not None]
        least[r] = min(ids) if ids else None
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 400)}"
    passage = [word() for _ in range(30)]
    rows = []
    for _ in range(n):
        base = [word() for _ in range(rng.choice([1, 3, 5, 8, 40, 90, 150]))]
        if rng.random() < 0.5:
            base += passage
        rows.append(base)
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 14))):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy = copy[:rng.randint(1, len(copy))]
            rows.append(copy)
    rng.shuffle(rows)
    return [(i * 3, rng.choice([" ", "\n", "  "]).join(w).upper() if rng.random() < 0.2 else " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_all_pairs(make_docs, seed):
    rows = corpus(seed) + [(7001, None), (7002, ""), (7003, " \t"), (7004, "É é"), (7005, "É É"), (7004, "É é"), (None, "only me here"),
                           (None, "w1 w2 w3 w4 w5 w6"), (7006, "w1 w2 w3 w4 w5 w6"), (7007, "word " * 30_000)]
    got = j.component_rows(make_docs(rows, clashing=True)).collect()
    assert sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == brute(rows)


def test_hot_groups(make_docs):
    """A third of the rows are copies, a third near copies, and all share a passage."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join(base)) for i in range(150)]
    for i in range(150):
        near = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            near[rng.randrange(60)] = f"n{i}-{rng.random()}"
        rows.append((1000 + i, " ".join(near)))
    rows += [(2000 + i, " ".join(f"o{i}-{k}" for k in range(50)) + " " + passage) for i in range(150)]
    got = j.component_rows(make_docs(rows)).collect()
    assert sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == brute(rows)


def test_exact_threshold():
    import numpy as np

    def pair(shared, a, b):
        common = np.arange(shared, dtype=np.uint64)
        values = [np.concatenate([common, np.arange(1000 * k, 1000 * k + n - shared, dtype=np.uint64)]) for k, n in ((1, a), (2, b))]
        from tallyframe.llm.common import mix64

        return [np.sort(mix64(v)) for v in values]

    for shared, a, b in ((6, 7, 7), (75, 75, 100), (75, 80, 95), (3, 3, 4), (1, 1, 1), (60, 70, 70)):
        union = a + b - shared
        assert j.sets_link(*pair(shared, a, b)) == (100 * shared >= 75 * union)
        assert not j.sets_link(*pair(shared - 1, a, b)) or 100 * (shared - 1) >= 75 * (union + 1)


def test_keep_first(make_docs):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (3, text), (9, text + " more"), (3, text), (8, "other words that stand alone here"), (1, None), (2, ""), (None, text)]
    docs = make_docs(rows, clashing=True)
    kept = j.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 8]
    assert j.keep_first(docs.limit(0)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(201, 200), (200, 202), (202, 201), (300, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)} | {200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
