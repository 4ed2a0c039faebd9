"""Incremental reads and stateful suppression with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def arriving(spark: SparkSession, path: str, schema: T.StructType, files_a_batch: int | None = None) -> DataFrame:
    """Stream of the Parquet files that come to a folder; what was read is kept by the query's checkpoint."""
    r = spark.readStream.schema(schema).format("parquet")
    return (r.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else r).load(path)


def first_only(stream: DataFrame, keys: Sequence[str], time: str, wait: str) -> DataFrame:
    """The first row of each key; keys older than ``wait`` are forgotten, so the state is bounded."""
    return stream.withWatermark(time, wait).dropDuplicatesWithinWatermark(list(keys))


def windowed(stream: DataFrame, time: str, wait: str, size: str, by: Sequence[str]) -> DataFrame:
    """``window_start, by, n`` of tumbling windows; rows later than ``wait`` do not count."""
    g = stream.withWatermark(time, wait).groupBy(F.window(time, size), *by).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("window.start").alias("window_start"), *by, "n")


def drained(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run over all that is there, write it once, and stop; the next call goes on where this one ended."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def newest(seen: DataFrame, time: str) -> str | None:
    """Greatest time so far, as the ``since`` of the next read."""
    return seen.agg(F.max(time).cast("string")).first()[0]


def settled(snapshots: DataFrame, key: str, state: str, at: str, terminal: Sequence[str], limit_s: int) -> DataFrame:
    """``key, outcome`` from landed snapshots of polled states: the first terminal state, ``waiting``, or ``timeout`` if none came in time."""
    s = F.lower(F.trim(state))
    done = F.min_by(F.when(s.isin(*terminal), s), F.when(s.isin(*terminal), F.col(at)))
    waited = F.max(at).cast("double") - F.min(at).cast("double")
    return snapshots.groupBy(key).agg(done.alias("done"), waited.alias("waited")).select(key, F.coalesce("done", F.when(F.col("waited") > limit_s, "timeout").otherwise("waiting")).alias("outcome"))


def unsuppressed(alerts: DataFrame, key: str, at: str, fingerprint: str, cooldown_s: int) -> DataFrame:
    """Alerts to send: those whose fingerprint differs from the key's alert before, or that come after the cool-down."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(at)
    gap = F.col(at).cast("double") - F.lag(at).over(w).cast("double")
    before = F.lag(fingerprint).over(w)
    return alerts.withColumn("_send", before.isNull() | (before != F.col(fingerprint)) | (gap > cooldown_s)).where("_send").drop("_send")
