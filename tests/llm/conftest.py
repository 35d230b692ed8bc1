from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

# Column names that operators use inside or put out; as extra input columns
# they must neither break an operator nor be changed by it.
CLASHING = [
    "ledger", "measures", "mix", "size", "target", "taken", "copies", "sharding", "shard", "slot", "hash", "words",
    "id", "node", "n", "token", "benchmark_hits", "spans", "score", "language", "n_tokens", "rank", "root", "u", "i",
    "_mix_size", "_shard_hash", "_hit_id", "_jac_id", "copy",
]


@pytest.fixture(scope="module")
def make_docs(spark):
    """Rows of ``documents`` from (doc_id, text[, lang[, source]])."""
    def make(rows, clashing=False):
        full = []
        for i, row in enumerate(rows):
            doc_id, text, lang, source = (*row, *("en", "s0")[len(row) - 2:])
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOCS)
        if clashing:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit(f"x{j}").alias(c) for j, c in enumerate(CLASHING)])
        return df

    return make


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
