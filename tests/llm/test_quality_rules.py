"""Quality rules against a brute-force version, and their defined cases."""

from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import pyarrow as pa

from tallyframe.llm import quality_rules as q
from tests.llm.conftest import CLASHING

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    twice = Counter(windows)
    covered = {p for i, w in enumerate(windows) if twice[w] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(lines), len(re.findall("[A-Za-z]", text)), len(re.findall("[A-Z]", text)),
    )


PIECES = st.sampled_from(["a", "b", "éß", "字", "\n", " ", "\t", "x#", "A|", "a b c d e f g h", "\x0b", "\x00", " ", "😀"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(PIECES, max_size=60).map(" ".join), st.lists(PIECES, max_size=20).map("".join)), max_size=6))
def test_measurements_equal_brute_force(texts):
    got = q._measure(pa.array(texts, pa.string())).to_pylist()
    assert [tuple(g[m] for m in q.MEASURES) for g in got] == [brute(t) for t in texts]


def test_very_long_text_and_sliced_array():
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    array = pa.array(["x", long, None, "", long + " é"])[1:]
    got = q._measure(array).to_pylist()
    assert [tuple(g[m] for m in q.MEASURES) for g in got] == [brute(t) for t in array.to_pylist()]
    assert got[0]["n_repeat_words"] == 60_000


def test_policy_keeps_clean_text_and_columns(spark, make_docs):
    clean = "The quick brown fox jumps over the lazy dog while thirty other animals look on in quiet wonder today.\nA second line follows here."
    rows = [(1, clean), (1, clean), (2, None), (3, ""), (4, "few words"), (None, clean), (5, "SHOUT!! " * 3 + "LOUD WORDS ALL AROUND " * 6),
            (6, " ".join(f"w{i}***" for i in range(40))), (7, "same line of text here\n" * 12)]
    docs = make_docs(rows, clashing=True)
    kept = q.keep_passing(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [(False, 1), (False, 1), (True, None)]
    assert all(r[c] == f"x{j}" for r in kept.collect() for j, c in enumerate(CLASHING))
    assert q.keep_passing(docs.limit(0)).count() == 0


def test_versions_and_ablations(spark, make_docs):
    docs = make_docs([(i, t) for i, t in enumerate([
        "ok " + " ".join(f"w{i}" for i in range(30)), "few", None, " ".join(f"w{i}###" for i in range(40)),
        "UP " * 25, "A LOUD ## ## ## ## ##"])])
    ledgers, name = q.with_ledger(docs)
    got = {r["rule"]: (r["failed"], r["only"], r["kept_without"]) for r in q.ablations(ledgers, name, "v2").collect()}
    rows = ledgers.select(F.col(name)["failures"].alias("f")).collect()
    mask = q.POLICIES["v2"]
    for rule, bit in ((r, 1 << i) for i, (r, _) in enumerate(q.RULES) if mask >> i & 1):
        assert got[rule] == (
            sum(bool(r["f"] & bit) for r in rows), sum((r["f"] & mask) == bit for r in rows),
            sum((r["f"] & mask & ~bit) == 0 for r in rows))
    base = ledgers.filter(q.passes(name, "base")).count()
    assert base >= ledgers.filter(q.passes(name, "v1")).count() >= ledgers.filter(q.passes(name, "v2")).count()


def test_ledger_is_one_pass_without_shuffle(make_docs):
    from tallyframe.plans.inspect import plan_text

    plan = plan_text(q.with_ledger(make_docs([(1, "a")]))[0])
    assert "Exchange" not in plan and plan.split("\n\n")[0].count("ArrowEvalPython") == 1
