"""Operators without SQL against plain Python: language ranks and distances, FTRL, placement into shards."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import language_id, sharding, toxicity
from tallyframe.llm.common import hash_fraction

# ------------------------------------------------------------------ language


def grams(text):
    """1- to 3-letter grams of the words, each word between blanks."""
    found = Counter()
    for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        found.update(word)
        padded = f" {word} "
        for size in (2, 3):
            found.update(padded[i:i + size] for i in range(len(padded) - size + 1))
    return found


def in_order(found, size):
    """Most frequent first; ties: three letters, one, two, then by code point with a blank as 0."""
    place = {3: 0, 1: 1, 2: 2}
    key = lambda g: (-found[g], place[len(g)], [0 if c == " " else ord(c) for c in g])
    return sorted(found, key=key)[:size]


def nearest(text, profiles, size):
    mine = in_order(grams(text), language_id.DOC_GRAMS)
    if not mine:
        return "und", 0.0
    out = {}
    for lang, ranks in profiles.items():
        out[lang] = sum(min(abs(ranks[g] - i), size) if g in ranks else size for i, g in enumerate(mine))
    best = min(sorted(out), key=out.get)
    return best, 1 - out[best] / (len(mine) * size)


@pytest.mark.parametrize("size", [15, 120, 1000])
def test_language_equals_plain_ranks_and_distances(spark, make_docs, size):
    rng = random.Random(size)
    letters = {"aa": "abcdeéß", "bb": "cdefgh", "cc": "абвгде", "dd": "漢字仮名"}
    word = lambda lang: "".join(rng.choice(letters[lang]) for _ in range(rng.randrange(1, 6)))
    text = lambda lang: "".join(word(lang) + rng.choice([" ", ", ", "-", "\n", "7"]) for _ in range(rng.randrange(1, 60)))
    train = [(i, text(lang), lang) for i, lang in enumerate(sorted(letters) * 12)] + [(900, None, "aa"), (901, "zz", None), (902, "", "bb")]
    totals = defaultdict(Counter)
    for _, t, lang in train:
        if lang:
            totals[lang].update(grams(t))
    plain = {lang: {g: r for r, g in enumerate(in_order(found, size))} for lang, found in totals.items()}
    profiles = language_id.train(make_docs(train), profile_size=size)
    probes = [text(rng.choice(sorted(letters))) + text(rng.choice(sorted(letters))) for _ in range(60)]
    probes += [None, "", "12 !", "q", "Ab aB AB", "x" * 5000, text("aa") * 300, "ΑΒΓ"]
    out, name = language_id.with_language(make_docs(list(enumerate(probes))), profiles)
    got = {r["doc_id"]: (r[name]["lang"], r[name]["score"]) for r in out.collect()}
    for i, t in enumerate(probes):
        lang, score = nearest(t, plain, size)
        assert got[i][0] == lang and math.isclose(got[i][1], score, abs_tol=1e-12), t


# ------------------------------------------------------------------ toxicity


def features(text):
    words = re.findall(r"[a-z0-9\x80-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return set(words) | {("next", *p) for p in zip(words, words[1:])} | {("skip", *p) for p in zip(words, words[2:])}


def textbook_ftrl(rows, base):
    """FTRL-proximal by coordinate over named features, one row after the other."""
    seen = Counter(f for t, _ in rows for f in features(t))
    least = max(2, min(toxicity.MIN_SEEN, len(rows) // 2000))
    l1 = toxicity.L1_PER_ROOT_ROW * math.sqrt(len(rows))
    z, n = defaultdict(float), defaultdict(float)

    def weight(f):
        if abs(z[f]) <= l1:
            return 0.0
        return -(z[f] - math.copysign(l1, z[f])) / ((toxicity.BETA + math.sqrt(n[f])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for text, y in rows:
            known = [f for f in features(text) if seen[f] >= least]
            w = {f: weight(f) for f in known}
            g = 1 / (1 + math.exp(-(base + math.fsum(w.values())))) - y
            for f in known:
                sigma = (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / toxicity.ALPHA
                z[f] += g - sigma * w[f]
                n[f] += g * g
    return {f: weight(f) for f in list(z)}


def test_toxicity_equals_textbook_ftrl(spark, make_docs):
    rng = random.Random(3)
    words = ["sun", "Rain", "tree", "été", "stone", "mean", "vile", "no1"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 9))) for _ in range(300)]
    marks = [int(("vile" in t) != (rng.random() < 0.1)) for t in texts]
    docs = make_docs(list(enumerate(texts)))
    labels = spark.createDataFrame(list(enumerate(marks)), "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    at = {r["doc_id"]: r["u"] for r in docs.select("doc_id", hash_fraction("doc_id").alias("u")).collect()}
    rows = [(texts[i], marks[i]) for i in sorted(at, key=lambda i: (at[i], i))]
    rate = (sum(marks) + 1) / (len(marks) + 2)
    base = math.log(rate / (1 - rate))
    weights = textbook_ftrl(rows, base)
    assert len(model.slots) == sum(w != 0 for w in weights.values())
    probes = [*texts, "vile vile VILE", "unseen words", "", "été été mean no1"]
    want = [1 / (1 + math.exp(-(base + math.fsum(weights.get(f, 0.0) for f in features(t))))) for t in probes]
    assert np.allclose(model.scores(pa.array(probes)).to_numpy(zero_copy_only=False), want, atol=1e-9)


# ------------------------------------------------------------------ sharding


def plain_place(vectors, n_shards):
    """One vector after the other, largest share first, to the shard with the highest product."""
    total = [sum(v[k] for v in vectors) or 1 for k in range(3)]
    shares = [[v[k] / total[k] for k in range(3)] for v in vectors]
    left = [[1.0 / n_shards] * 3 for _ in range(n_shards)]
    out = [0] * len(vectors)
    for i in sorted(range(len(vectors)), key=lambda i: (-max(shares[i]), i)):
        products = [sum(e * s * r for e, s, r in zip(sharding.EMPHASIS, shares[i], room)) for room in left]
        best = max(range(n_shards), key=lambda s: (products[s], -s))
        out[i] = best
        left[best] = [r - s for r, s in zip(left[best], shares[i])]
    return out


def test_place_equals_the_plain_loop():
    rng = random.Random(5)
    for n in (1, 7, 40, 400):
        vectors = [[rng.randrange(1, 900), rng.randrange(0, 90), rng.randrange(1, 9)] for _ in range(n)]
        assert sharding.place(np.array(vectors, float), 8).tolist() == plain_place(vectors, 8)
    assert sharding.place(np.ones((5, 3)), 3).tolist() == plain_place([[1, 1, 1]] * 5, 3)


def test_shards_equal_plain_bundles_groups_and_pieces(spark, make_docs):
    rng, bundles, n_shards = random.Random(9), 16, 4
    rows = [(i, "copied " * 6) for i in range(400)]
    rows += [(1000 + i, f"own {rng.randrange(250)} " + "w " * rng.randrange(40)) for i in range(600)]
    rows += [(3000 + i, "medium copies " * 3) for i in range(120)] + [(None, None), (5, None), (6, "")]
    docs = make_docs(rows)
    hashed, piece = F.xxhash64("text", F.col("text").isNull()), F.pmod(F.xxhash64(F.lit("piece"), "doc_id"), F.lit(sharding.PIECES))
    of = docs.select("doc_id", "text", hashed.alias("h"), piece.alias("p"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("c")).collect()
    sizes = lambda t: (len((t or "").encode()) + 1, len((t or "").split()), 1)
    groups, pieces = defaultdict(lambda: [0] * 3), defaultdict(lambda: [0] * 3)
    for r in of:
        key = (r["h"], r["c"], sizes(r["text"])[0])
        for k, x in enumerate(sizes(r["text"])):
            groups[key][k] += x
            pieces[key, r["p"]][k] += x
    total = [sum(v[k] for v in groups.values()) for k in range(3)]
    above = lambda v, share: any(x > total[k] * share for k, x in enumerate(v))
    items = defaultdict(lambda: [0] * 3)
    for key, v in groups.items():
        if above(v, 1 / n_shards):
            items.update({(*key, p, None): x for (g, p), x in pieces.items() if g == key})
        elif above(v, 1 / bundles):
            items[*key, None, None] = v
        else:
            b = items[None, None, None, None, key[0] % bundles]
            for k in range(3):
                b[k] += v[k]
    assert {(i[3] is None, i[4] is None) for i in items} == {(True, True), (True, False), (False, True)}
    order = sorted(items, key=lambda i: tuple((x is not None, x) for x in (*i, *items[i])))
    shard = dict(zip(order, plain_place([items[i] for i in order], n_shards)))

    def of_row(r):
        key = (r["h"], r["c"], sizes(r["text"])[0])
        return next(shard[i] for i in ((*key, r["p"], None), (*key, None, None), (None, None, None, None, key[0] % bundles)) if i in shard)

    out, name = sharding.assign_shards(docs, n_shards, bundles=bundles)
    got = Counter((r["doc_id"], r["text"], r[name]["shard"]) for r in out.collect())
    assert got == Counter((r["doc_id"], r["text"], of_row(r)) for r in of)
