"""Prefix token counts against the tokenizer library."""

from __future__ import annotations

import duckdb
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyframe.llm import token_counts as tc
from tests.conftest import SF_ORACLE

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


def count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


ALPHABET = st.sampled_from(list(" \n\t'’srevlmdtaZ9é!<|>　 字😀#") + ["<|endoftext|>", "  ", "'re", "don't", "thanedble"])


@settings(max_examples=200, deadline=None)
@given(st.lists(ALPHABET, max_size=14).map("".join))
def test_every_prefix_equals_the_library(text):
    lib = LIBRARY
    counts = tc.counter(PATH).prefix_counts(text)
    assert counts.tolist() == [count(lib, text[:i]) for i in range(len(text) + 1)]
    assert tc.counter(PATH).batch_totals(pa.array(["x", text, None]))[1] == counts[-1]


def test_code_point_classes_equal_the_library(library):
    text = "".join(f"a{chr(c)}!" for c in range(0x21, 0x30000) if not 0xD800 <= c < 0xE000)
    mine, starts, at = tc.counter(PATH).pieces(text), [], 0
    for piece in mine:
        starts.append(at)
        at += len(piece)
    assert starts == [a for _, (a, _) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_whole_table_equals_the_library(spark, library):
    from tallyframe.llm.queries import op5_token_counts

    got = {r["doc_id"]: r for r in op5_token_counts(spark, SF_ORACLE).collect()}
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF_ORACLE}/documents.parquet'").fetchall()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        n = count(library, text or "")
        assert (got[doc_id]["n_tokens"], got[doc_id]["n_bytes"], got[doc_id]["over_limit"]) == (n, len((text or "").encode()), n > 1024)


def test_a_small_memory_gives_the_same_counts(library, monkeypatch):
    monkeypatch.setattr(tc, "CACHE_PIECES", 3)
    text = "many different words fill the little memory again and again " * 3
    assert tc.PrefixCounter(PATH).batch_totals(pa.array([text])).tolist() == [count(library, text)]


def test_truncation_and_arrays(spark, make_docs, library):
    docs = make_docs([(1, "The thanedble fox, don't you know?\n\n  Yes."), (2, None), (3, ""), (4, "é" * 50), (1, "a" * 5000)], clashing=True)
    out, name = tc.truncated(docs, PATH, 5)
    assert out.columns == [*docs.columns, name] and name == "text_cut"
    cut = out.select("text", "text_cut").collect()
    for r in cut:
        if r["text"] is None:
            assert r["text_cut"] is None
        else:
            best = max(i for i in range(min(len(r["text"]), 400) + 1) if count(library, r["text"][:i]) <= 5)
            assert r["text_cut"] == r["text"][:best]
    arrays = tc.with_prefix_counts(docs, PATH)[0].select(F.size("prefix_counts").alias("n"), "text").collect()
    assert all(r["n"] == len(r["text"] or "") + 1 for r in arrays)
    out, name = tc.with_token_counts(docs, PATH)
    assert out.columns == [*docs.columns, name] and out.drop(name).collect() == docs.collect()
    assert [r[name] for r in out.collect()] == [count(library, r["text"] or "") for r in docs.collect()]
    assert tc.with_token_counts(docs.limit(0), PATH)[0].count() == 0
