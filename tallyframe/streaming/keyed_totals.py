"""Running totals per key, for more keys than fit in memory.

State lives in RocksDB on the executors' disks, and each batch uploads only its
changes to the checkpoint (changelog checkpoints), not the whole state.  The
query runs in ``update`` mode: a batch hands over only the keys it touched, with
their new totals, and those rows are written once per batch through the ledger
(``streaming.ledger``).  So published bytes follow the changed keys.

A reader takes each key's row of the highest batch: one ``max_by`` over the
committed batches.  When the rows of the batches since the last base outgrow
that base, they are merged into a new base; each row is therefore rewritten a
bounded number of times on average, and a reader opens at most about twice the
rows there are keys.  A base counts from its own ledger entry; the batches and
the older base that it replaces are dropped one base later, so a reader that
has resolved its folders keeps them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import money_parts, parts_amount
from tallyframe.functions.money import PARTS
from tallyframe.schemas import TABLES
from tallyframe.sinks.files import write_counted
from tallyframe.streaming.ledger import AFTER_WRITE, Ledger, Steps, no_steps, write_once
from tallyframe.streaming.purchases import MAX_FILES_PER_TRIGGER, event_stream, run_to_end

# State partitions of a key with many values; fixed in the checkpoint at the first run.
STATE_PARTITIONS = 32
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# A base is made once the batches since the last one hold so many times its rows.
MERGE_AT = 1.0


def keyed_totals(events: DataFrame, key: str) -> DataFrame:
    """Stateful aggregate: the key, ``n`` and the summed parts of the value."""
    return events.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(part).alias(name) for name, part in zip(PARTS, money_parts("value", "value").values(), strict=True)],
    )


def _schema(key: str) -> T.StructType:
    return T.StructType([
        T.StructField(key, TABLES["events"][key].dataType), T.StructField("n", T.LongType()), T.StructField("total_value", T.DoubleType()),
    ])


def _ledgers(spark: SparkSession, root: str) -> tuple[Ledger, Ledger]:
    """Ledgers of the batches and of the bases; a base's id is the last batch in it."""
    return Ledger(spark, f"{root.rstrip('/')}/changes"), Ledger(spark, f"{root.rstrip('/')}/bases")


def _merged(spark: SparkSession, root: str, key: str) -> tuple[DataFrame, int, int, int]:
    """The newest row of every key; the last base, and the rows in it and in the batches since."""
    changes, bases = _ledgers(spark, root)
    made, batches = bases.batches(), changes.batches()
    base = max(made, default=-1)
    since = [b for b in batches if b > base]
    rows = changes.read(_schema(key), since).unionByName(bases.read(_schema(key), [base] if made else []))
    newest = rows.groupBy(key).agg(F.max_by(F.struct("n", "total_value"), "batch_id").alias("v")).select(key, "v.n", "v.total_value")
    return newest, base, made.get(base, 0), sum(batches[b] for b in since)


def latest_keyed_totals(spark: SparkSession, root: str, key: str) -> DataFrame:
    """``<key>``, ``n``, ``total_value`` of all committed batches."""
    return _merged(spark, root, key)[0]


def merge_changes(spark: SparkSession, root: str, key: str, merge_at: float = MERGE_AT, steps: Steps = no_steps) -> bool:
    """Make a new base if the batches since the last hold ``merge_at`` times its rows; True if it was made.

    Dying on the way leaves the old base and its batches in force; a repeated
    merge of the same batches rewrites the same folder.
    """
    changes, bases = _ledgers(spark, root)
    newest, base, base_rows, new_rows = _merged(spark, root, key)
    if new_rows == 0 or new_rows < merge_at * base_rows:
        return False
    upto = max(changes.batches())
    rows = write_counted(newest, lambda df: df.write.mode("overwrite").parquet(bases.folder(upto)))
    steps(AFTER_WRITE, upto)
    bases.commit(upto, rows)
    # What the base before this one replaced is no longer opened by anyone.
    changes.forget([b for b in changes.batches() if b <= base])
    bases.forget([b for b in bases.batches() if b < base])
    return True


def run_keyed_totals(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    checkpoint_dir: str,
    key: str = "user_id",
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    state_partitions: int = STATE_PARTITIONS,
    merge_at: float = MERGE_AT,
    steps: Steps = no_steps,
) -> int:
    """Fold every new file into the totals, publish the changed keys, stop; returns rows read."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    for name, value in STATE_CONF.items():
        own.conf.set(name, value)
    changes, _ = _ledgers(spark, output_dir)
    write = write_once(changes, steps)

    def publish(batch: DataFrame, batch_id: int) -> None:
        write(batch.select(key, "n", parts_amount(*PARTS).alias("total_value")), batch_id)
        merge_changes(spark, output_dir, key, merge_at)

    writer = (
        keyed_totals(event_stream(own, input_dir, max_files_per_trigger), key)
        .writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
    )
    return run_to_end(own, writer.start)
