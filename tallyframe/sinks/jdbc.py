"""Replace a database table from a DataFrame without a window of emptiness.

Spark's JDBC ``overwrite`` drops (or truncates) the target and then loads it,
so readers can see an empty or half-loaded table and a failed load loses the
old rows.  Here the executors load a staging table in parallel, the staged
row count is checked against the DataFrame, and only then is the target
replaced inside one database transaction (``DELETE`` + ``INSERT ... SELECT``
run by the database itself; no rows pass through the driver).

Not exercised by the test suite: it needs a database, and this repository's
tests start none (see README).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyframe.sinks.files import write_counted


def staged_count(spark: SparkSession, url: str, table: str, properties: dict[str, str]) -> int:
    row = spark.read.jdbc(url, f"(SELECT COUNT(*) AS n FROM {table}) staged", properties=properties).first()
    return int(row["n"]) if row is not None else 0


def replace_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    staging_table: str | None = None,
    num_partitions: int = 8,
) -> int:
    """Load ``df`` into ``table`` by staging and swapping; returns the row count.

    ``properties`` must carry the credentials (``user``, ``password``) and the
    ``driver`` class; nothing has a default.
    """
    for key in ("user", "password", "driver"):
        if key not in properties:
            raise ValueError(f"JDBC property {key!r} is required")
    spark = df.sparkSession
    # A name of its own per run, so two loads at once never mix.
    staging = staging_table or f"{table}_staging_{uuid.uuid4().hex[:12]}"
    # ``num_partitions`` bounds the concurrent connections into the database.
    # A repartition (not coalesce) keeps the stages that compute ``df`` at
    # full parallelism; the row count is observed during the write itself.
    expected = write_counted(
        df,
        lambda d: d.repartition(num_partitions).write.jdbc(url, staging, mode="overwrite", properties=properties),
    )
    loaded = staged_count(spark, url, staging, properties)
    if loaded != expected:
        raise RuntimeError(f"staging table {staging} has {loaded} rows, expected {expected}")
    # The swap runs as one transaction on a single driver-side connection;
    # PySpark has no public JDBC connection API, so the JVM's DriverManager
    # (with the same driver jar the executors use) is reached via the gateway.
    jvm = spark.sparkContext._jvm
    jprops = jvm.java.util.Properties()
    for key, value in properties.items():
        jprops.setProperty(key, value)
    jvm.java.lang.Class.forName(properties["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(url, jprops)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        stmt.executeUpdate(f"DELETE FROM {table}")
        stmt.executeUpdate(f"INSERT INTO {table} SELECT * FROM {staging}")
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        if staging_table is None:
            conn.setAutoCommit(True)
            conn.createStatement().executeUpdate(f"DROP TABLE {staging}")
        conn.close()
    return loaded
