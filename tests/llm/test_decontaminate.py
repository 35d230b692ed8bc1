"""Winnowing against a brute-force search of every window."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate as d
from tests.llm.conftest import CLASHING

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            n = min(13, len(v))
            windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
            places = [i for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in windows] if n else []
            for i in places:
                hit.update(range(i, i + n))
            if places and item_id is not None:
                found.add(str(item_id))
        out.append((doc_id, len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def rows_and_items(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "ß9", "字"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))

    items = [(i, text(rng.choice([5, 13, 14, 20, 40]))) for i in range(12)]
    items += [(50, "One"), (51, "two words"), (52, "a B c"), (53, None), (54, "..."), (None, text(15)), (3, text(20)), (55, items[2][1])]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            source = words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(source) - 1))
            parts += [" ".join(source[a:a + rng.randint(1, 40)]).upper(), text(rng.randint(0, 20))]
        docs.append((i, " ".join(parts)))
    docs += [(100, None), (101, ""), (102, "?!"), (7, docs[7][1]), (7, docs[7][1]), (None, items[0][1]), (103, (text(40) + items[4][1]) * 60)]
    return docs, items


@pytest.mark.parametrize("seed,limit", [(0, 10**6), (1, 10**6), (2, 0)])
def test_equals_brute_force(spark, make_docs, seed, limit):
    docs, items = rows_and_items(seed)
    frame = make_docs(docs, clashing=True)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out, name = d.with_hits(frame, bench, max_broadcast_rows=limit)
    h = F.col(name)
    rows = out.select("doc_id", *[h[c].alias(c) for c in ("n_words", "n_hit")], h["item_ids"].alias("items"), h["contaminated"].alias("bad"), "spans").collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]), r["bad"]) for r in rows), key=repr)
    assert got == brute(docs, items)
    assert all(r["spans"] == f"x{CLASHING.index('spans')}" for r in rows)


def test_empty_tables_and_filter(spark, make_docs):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p")], "item_id bigint, text string")
    docs = make_docs([(1, "x y z " * 30), (2, "A B C D E F G H I J K L M N"), (None, None)])
    assert sorted(r["doc_id"] or 0 for r in d.drop_contaminated(docs, bench).collect()) == [0, 1]
    assert d.drop_contaminated(docs, bench).columns == docs.columns
    assert d.drop_contaminated(docs, bench.limit(0)).count() == 3
    assert d.drop_contaminated(docs.limit(0), bench).count() == 0


def test_no_python_and_no_shuffled_text(spark, make_docs):
    from tallyframe.plans.inspect import plan_text

    docs, items = rows_and_items(4)
    out, _ = d.with_hits(make_docs(docs).select("doc_id", "text"), spark.createDataFrame(items, "item_id bigint, text string"))
    plan = plan_text(out.drop("text"))
    assert not re.search("EvalPython|InPandas|InArrow|EvalArrow", plan) and "Cartesian" not in plan and "NestedLoop" not in plan
