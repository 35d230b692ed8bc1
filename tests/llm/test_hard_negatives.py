"""Hard negatives against all inner products."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tallyframe.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, n_pos=5, n_neg=10, every=100):
    clean = {}
    for i, v, label in rows:
        if label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        clean[(i, label, tuple(math.floor(256 * float(np.float32(c))) for c in v))] = None
    clean = list(clean)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    first = lambda found, k: sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:k]
    out = []
    for a, la, x in clean:
        if a is None or a % every:
            continue
        scored = [(dot(x, y), i, lb) for i, lb, y in clean if i != a]
        for ps, p, _ in first([s for s in scored if s[2] == la], n_pos):
            inside = [s for s in scored if s[2] != la and 30 * ps <= 100 * s[0] <= 90 * ps]
            out += [(a, p, r + 1, n, ps, ns) for r, (ns, n, _) in enumerate(first(inside, n_neg))]
    return sorted(out, key=repr)


def vectors(seed, n=400, dim=8, ids=None):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        spread = rng.choice([0.0, 0.05, 0.5, 1.0])
        rows.append((i, [x + rng.gauss(0, spread) for x in c], rng.randrange(4)))
    return rows


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    clean = hn.clean_rows(df, "vec_id", "label", "embedding")
    out = hn.mine(clean, clean.filter("id % 100 = 0"), **options)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r[c] for c in names) for r in out.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_over_many_trees(spark, seed):
    rows = vectors(seed)
    assert run(spark, rows, chunk=64, query_block=3) == brute(rows)


def test_one_vector_held_by_a_third_of_the_rows_is_split(spark):
    rows = vectors(5, 300)
    rows = [(i, rows[0][1] if i % 3 == 0 else v, label) for i, v, label in rows]
    df = hn.clean_rows(spark.createDataFrame(rows, SCHEMA), "vec_id", "label", "embedding")
    sizes = [len(r["ids"]) for r in hn.build_index(df, chunk=32).trees.collect()]
    assert sum(sizes) == 300 and max(sizes) < 100
    assert run(spark, rows, chunk=32) == brute(rows)


def test_defined_cases(spark):
    rows = vectors(7, 210)
    rows += [(300, None, 1), (301, [1.0, None] + [0.0] * 6, 1), (302, [float("nan")] * 8, 1), (303, [float("inf")] * 8, 2),
             (304, [0.5] * 8, None), (None, rows[0][1], 1), (None, rows[1][1], rows[0][2]), (305, [1.0], 1), (400, [], 2),
             (100, rows[3][1], 3), rows[5], rows[100], (500, [0.0] * 8, 1)]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_single_row(spark):
    assert run(spark, []) == []
    assert run(spark, [(100, [1.0, 2.0], 1)]) == []


def test_ties_go_by_ascending_id(spark):
    rows = [(i, [1.0, 0.0] if i % 2 else [0.5, 0.5], i % 3) for i in range(201)]
    assert run(spark, rows) == brute(rows)


def test_vectors_beyond_exact_scores_are_refused(spark):
    with pytest.raises(ValueError, match="2\\^53"):
        run(spark, [(100, [1e9, 1e9], 1), (1, [1e9, 1.0], 1)])


def test_cover_tree_covers_and_separates():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(size=(200, 5)), np.repeat(rng.normal(size=(1, 5)), 40, axis=0)])
    nodes, leaves = hn.cover_tree(points)
    assert sorted(np.concatenate([x for x in leaves if x is not None])) == list(range(240))
    for at, node in enumerate(nodes):
        d = np.linalg.norm(points[node.members] - points[node.centre], axis=1)
        assert np.allclose(d, node.far)
        children = [n for n in nodes if n.parent == at]
        if children:
            radius = node.far.max() / hn.BASE
            assert node.centre in [c.centre for c in children]
            centres = points[[c.centre for c in children]]
            apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)[~np.eye(len(centres), dtype=bool)]
            assert (apart > radius).all() and all(c.far.max() <= radius + 1e-9 for c in children)


def test_the_descent_skips_what_cannot_count():
    rng = np.random.default_rng(4)
    centres = np.floor(rng.normal(size=(40, 16)) * 256)
    x = np.repeat(centres, 50, axis=0) + np.floor(rng.normal(size=(2000, 16)) * 4)
    top = float(np.einsum("ij,ij->i", x, x).max())
    import pyarrow as pa
    table = pa.table({"id": pa.array(range(2000), pa.int64()), "label": pa.array([0] * 2000, pa.int32()), "x": pa.array(list(x))})
    tree = next(hn._trees(hn._build(table, 16, top).to_batches(), 16))
    q = x[:20]
    found = hn._Found(np.full((20, 1), -np.inf), 5)
    scored = hn.search_tree(tree, q, np.zeros(20, int), np.arange(20), True, np.full((20, 1), np.inf), top, found)
    exact = q @ x.T
    for i in range(20):
        want = sorted((-s, j) for j, s in enumerate(exact[i]) if j != i)[:5]
        assert [(-r[1], r[2]) for r in found.rows[found.rows[:, 0] == i]] == want
    assert scored < 0.25 * 20 * 2000
