"""The state of each slice as a stream: status, retries and update time, kept by key across batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.session import remove_dir
from sluice.streaming.ingest import start_batches

#: A state is forgotten when updates of other keys are newer by so much.
EXPIRY_DAYS = 90
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_STATE = ("status", "retries", "updated", "sequence")
_EXPIRY = "expiry_days"


def slice_states(updates: DataFrame, keys: Sequence[str], status: str, at: str, sequence: str, expiry_days: int = EXPIRY_DAYS) -> DataFrame:
    """Every run as a state of its own (keys, status, retries, updated, sequence), for ``write_states`` to fold.

    ``updates`` is a stream of runs.  Status and time of a key's state are
    those of the run that is newest by ``at`` and ``sequence``, in whatever
    order runs arrive; runs without a time are left out.  ``retries`` counts
    the runs after the first.  The watermark trails the newest update of
    earlier batches by ``expiry_days``: what it has passed is forgotten, and
    runs that old are no longer taken.
    """
    return updates.where(F.col(at).isNotNull()).select(
        *keys,
        F.coalesce(F.col(status), F.lit("")).alias("status"),
        F.lit(0).cast("bigint").alias("retries"),
        F.col(at).cast("timestamp").alias("updated", metadata={_EXPIRY: expiry_days}),
        F.coalesce(F.col(sequence).cast("bigint"), F.lit(-1)).alias("sequence"),
    )


def use_state_store(spark: SparkSession) -> None:
    """Keep the state of streaming aggregates in RocksDB, on the executors' disks, with its changes below the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def _watermark(held: DataFrame, expiry_days: int) -> Column:
    """What the newest update so far leaves behind; null before the first one."""
    newest = held.agg(F.unix_micros(F.max("updated")).alias("newest")).first()["newest"]
    return F.timestamp_micros(F.lit(newest).cast("bigint")) - F.make_dt_interval(F.lit(expiry_days))


def _folded(held: DataFrame, runs: DataFrame, keys: Sequence[str], mark: Column) -> DataFrame:
    """States after a batch, with ``changed`` where a run came in.

    One aggregate, which combines before the shuffle, so a key that most rows
    have sends few of them on.  Of runs of equal time and sequence the one
    held already counts.
    """
    kept = held.where(F.coalesce(F.col("updated") >= mark, F.lit(True))).withColumn("changed", F.lit(False))
    taken = runs.where(F.coalesce(F.col("updated") > mark, F.lit(True))).withColumn("changed", F.lit(True))
    newest = F.max(F.struct("updated", "sequence", (~F.col("changed")).alias("held"), "status")).alias("_newest")
    folded = kept.unionByName(taken).groupBy(*keys).agg(
        newest, (F.sum(F.col("retries") + 1) - 1).alias("retries"), F.bool_or("changed").alias("changed")
    )
    state = [folded["_newest"][c].alias(c) if c != "retries" else folded[c] for c in _STATE]
    return folded.select(*keys, *state, "changed")


def _held(spark: SparkSession, folder: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """The states that the batch before left; none before the first."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/batch={batch_id - 1}").select(*schema.names)


def write_states(states: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Each batch's updated states in a folder of its own, which a batch that runs again overwrites.

    All states are a table below the checkpoint, a version per batch.  A batch
    folds its runs into the version of the batch before, so one that runs again
    comes to the same states.  The last two versions are kept.
    """
    keys = [c for c in states.columns if c not in _STATE]
    expiry_days = states.schema["updated"].metadata.get(_EXPIRY, EXPIRY_DAYS)
    folder = f"{checkpoint.rstrip('/')}/slice-states"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = _held(spark, folder, states.schema, batch_id)
        version = f"{folder}/batch={batch_id}"
        _folded(held, batch, keys, _watermark(held, expiry_days)).write.mode("overwrite").parquet(version)
        written = spark.read.parquet(version)
        written.where("changed").drop("changed").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if batch_id > 1:
            remove_dir(spark, f"{folder}/batch={batch_id - 2}")

    return start_batches(states, handle, checkpoint, once)


def current_states(spark: SparkSession, out: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The newest state of every key; an aggregate that combines before the shuffle."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])).parquet(out)
    state = F.max_by(F.struct("status", "retries", "updated"), "batch").alias("_s")
    return rows.groupBy(*keys).agg(state).select(*keys, "_s.*")
