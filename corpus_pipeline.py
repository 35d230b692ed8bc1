"""A corpus pipeline over ``documents``: each stage is one operator of ``tallyframe.llm``.

Stages are written as Parquet under the session's shared folder and read back,
so a lost executor costs at most the running stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import decontaminate, jaccard_join, mixing, quality_rules, sharding
from tallyframe.session import scratch_path
from tallyframe.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the quality rules keeps."""
    return quality_rules.keep_passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return jaccard_join.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more of the benchmark than the contamination rule allows."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.take_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot there."""
    return sharding.sharded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]

# Vector bin packing is sequential and has no SQL form; tests hold the
# pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
