"""Derive a larger data set from a given one, for scaling measurements only.

    python tools/scale_up.py SRC_DIR DST_DIR COPIES [TABLE ...]

Each table except ``region`` and ``nation`` is copied COPIES times with its
keys shifted per copy (so copies are new customers, parts, orders, ...), and
written as several files so scans can run in parallel.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tallyframe.session import build_session  # noqa: E402
from tallyframe.sources.memory import replicate  # noqa: E402
from tallyframe.sources.tables import read_table, table_path  # noqa: E402

# Key columns per table, shifted by copy * stride.
KEYS = {
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"],
    "events": ["event_id", "user_id"],
}
STRIDE = 10_000_000_000


def main(src: str, dst: str, copies: int, only: list[str]) -> None:
    spark = build_session("local[8]", shuffle_partitions=16, conf={"spark.driver.memory": "16g"})
    for name in only or ["region", "nation", *KEYS]:
        df = read_table(spark, src, name)
        if name in KEYS:
            df = replicate(df, copies, "__copy")
            shift = (F.col("__copy") - 1).cast("bigint") * STRIDE
            for key in KEYS[name]:
                df = df.withColumn(key, F.col(key) + shift)
            # 16 files of ~1/16 each; a hash of the shifted key spreads copies
            df = df.drop("__copy").repartition(16, KEYS[name][0])
        df.write.mode("errorifexists").parquet(table_path(dst, name))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]), sys.argv[4:])
