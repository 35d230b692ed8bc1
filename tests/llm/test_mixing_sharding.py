"""Mixing and sharding: laws, brute force, defined cases."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import mixing, sharding
from tests.llm.conftest import CLASHING


def test_targets_fill_by_weight_up_to_the_caps():
    sizes, weights = [10, 100, 1000, 0], [5.0, 2.0, 1.0, 5.0]
    got = mixing.targets(sizes, weights, 1.5 * sum(sizes), 2)
    assert sum(got) == pytest.approx(1.5 * sum(sizes))
    assert all(t <= 2 * s + 1e-9 for t, s in zip(got, sizes, strict=True))
    # by repeated resharing of the excess
    target, left, open_ = [0.0] * 4, 1.5 * sum(sizes), set(range(4))
    while open_:
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = {i for i in open_ if share[i] > 2 * sizes[i]}
        for i in over or open_:
            target[i] = 2.0 * sizes[i] if over else share[i]
        left -= sum(2.0 * sizes[i] for i in over)
        open_ = open_ - over if over else set()
    assert got == pytest.approx(target)
    assert mixing.targets([], [], 0, 2) == []


def brute_mix(rows):
    """taken by (doc_id, text, source), walking every source in key order."""
    by_source = defaultdict(list)
    for doc_id, text, source in rows:
        by_source[source].append((doc_id, len((text or "").split()), text))
    sources = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(n for _, n, _ in by_source[s]) for s in sources]
    weights = [float(mixing.WEIGHTS[i % 3]) for i in range(len(sources))]
    target = mixing.targets(sizes, weights, 1.5 * sum(sizes), 2)
    out = Counter()
    for s, t in zip(sources, target, strict=True):
        key = lambda d: int(hashlib.md5(f"mix:{'' if d[0] is None else d[0]}".encode()).hexdigest()[:15], 16)
        left = int(t + 1e-6)
        while left > 0:
            for doc_id, n, text in sorted(by_source[s], key=key):
                take = min(n, left)
                out[doc_id, text, s] += take
                left -= take
    return out


@pytest.mark.parametrize("rows_per_range", [1, 3, 4096])
def test_mix_equals_brute_force(make_docs, rows_per_range):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 13)), "en", ["a", "b", None, "c", "a", "a"][i % 6]) for i in range(60)]
    rows += [(100, None, "en", "a"), (101, "", "en", "c"), (102, "  \t ", "en", "empty"), (None, "one two", "en", "b")]
    docs = make_docs(rows, clashing=True)
    got, name = mixing.mix(docs, rows_per_range=rows_per_range)
    m = F.col(name)
    got = got.select("doc_id", "text", "source", m["taken"].alias("t"), m["size"].alias("s"), m["source_size"].alias("z"),
                     m["target"].alias("g"), *CLASHING).collect()
    want = brute_mix([(d, t, s) for d, t, _, s in rows])
    assert {(r["doc_id"], r["text"], r["source"]): r["t"] for r in got} == {(d, t, s): want[d, t, s] for d, t, _, s in rows}
    assert all(r["t"] <= 2 * r["s"] for r in got) and len(got) == len(rows)
    by = defaultdict(int)
    for r in got:
        by[r["source"]] += r["t"]
    assert all(abs(by[r["source"]] - r["g"]) < 1 for r in got)
    assert all(r[c] == f"x{j}" for r in got for j, c in enumerate(CLASHING))


def test_mix_repeated_rows_and_empty(make_docs):
    docs = make_docs([(1, "a b c")] * 4 + [(2, "a b")] * 3)
    a = sorted(tuple(r) for r in mixing.mix(docs)[0].select("doc_id", "mix.taken").collect())
    b = sorted(tuple(r) for r in mixing.mix(docs.repartition(5))[0].select("doc_id", "mix.taken").collect())
    assert a == b and sum(t for _, t in a) == 27
    out = mixing.take_mix(docs)
    assert out.columns == docs.columns and out.count() >= 7
    assert mixing.mix(docs.limit(0))[0].count() == 0 and mixing.take_mix(docs.limit(0)).count() == 0


def _shards(df):
    out, name = sharding.assign_shards(df)
    s = F.col(name)
    return out.select("doc_id", "text", s["size"].alias("size"), s["text_crc32"].alias("crc"), s["shard"].alias("shard"), s["slot"].alias("slot")).collect()


def check_shards(rows, n):
    assert len(rows) == n
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    for r in rows:
        raw = (r["text"] or "").encode()
        assert r["size"] == len(raw) + 1 and r["crc"] == zlib.crc32(raw)
    assert all(0 <= r["shard"] < 8 for r in rows)


def test_shards_balance_and_keep_groups_together(make_docs):
    rows = [(i, "word " * (1 + i % 37) + str(i // 2)) for i in range(2000)] + [(9000 + i, None) for i in range(5)] + [(None, "x"), (None, "x")]
    got = _shards(make_docs(rows, clashing=True))
    check_shards(got, len(rows))
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    assert max(load.values()) - min(load.values()) < 0.01 * sum(load.values()) / 8 + 50
    by_text = defaultdict(set)
    for r in got:
        by_text[r["text"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())


def test_a_group_of_a_third_of_all_rows_is_cut(make_docs):
    rows = [(i, "copied text of some length" if i % 3 == 0 else f"own text number {i}") for i in range(3000)]
    got = _shards(make_docs(rows))
    check_shards(got, len(rows))
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    assert max(load.values()) / min(load.values()) < 1.03
    assert len({r["shard"] for r in got if r["text"] == "copied text of some length"}) > 2


def test_many_parts_number_slots_without_gaps(make_docs):
    docs = make_docs([(i, f"t{i % 700}") for i in range(2100)])
    out, name = sharding.assign_shards(docs, rows_per_part=20)
    got = out.select(F.col(name)["shard"].alias("s"), F.col(name)["slot"].alias("k")).collect()
    for s in range(8):
        slots = sorted(r["k"] for r in got if r["s"] == s)
        assert slots == list(range(len(slots)))


def test_shards_of_few_and_no_rows(make_docs):
    docs = make_docs([(1, "a"), (1, "a"), (None, None)], clashing=True)
    check_shards(_shards(docs), 3)
    assert sharding.sharded(docs).columns == [*docs.columns, "shard_", "slot_"]
    assert _shards(docs.limit(0)) == []
