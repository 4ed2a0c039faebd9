"""Hash-chained logs: append and verify."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The hash before the first event.
GENESIS = "0" * 64


def event_hash(previous: Column, payload: Column) -> Column:
    return F.sha2(F.concat(previous, F.lit("|"), payload), 256)


def chained(events: DataFrame, within: Sequence[str], order: str, payload: Column, start: str = GENESIS) -> DataFrame:
    """``within, order, payload, previous_hash, event_hash``: each log's chain over its events in order.

    A chain is sequential by nature, but logs are independent: a log's events come to one task in
    order and are folded as they pass, so that no log, however long, is held in memory. An event
    with a null payload has no hash, and does not move the chain on.
    """
    rows = events.select(*within, order, payload.cast("string").alias("payload"))
    n = len(within)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log, last = None, start
        for b in batches:
            before, own = [], []
            for *key, p in zip(*(b.column(i).to_pylist() for i in (*range(n), n + 1))):
                if key != log:
                    log, last = key, start
                before.append(last)
                h = None if p is None else hashlib.sha256(f"{last}|{p}".encode()).hexdigest()
                own.append(h)
                last = h or last
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before, pa.string()), pa.array(own, pa.string())], [*b.schema.names, "previous_hash", "event_hash"])

    schema = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes)
    ordered = rows.repartition(*within).sortWithinPartitions(*within, order)
    return ordered.mapInArrow(fold, f"{schema}, previous_hash string, event_hash string")


def verified(log: DataFrame, within: Sequence[str], order: str, start: str = GENESIS) -> DataFrame:
    """``log`` with ``link_ok`` (previous_hash is the hash recorded before it) and ``hash_ok`` (the hash is the payload's).

    Rows without a hash (blank or broken lines) are bad, and do not move the chain on.
    """
    # the last recorded hash before the row, passing over rows without one
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.last("event_hash", ignorenulls=True).over(w), F.lit(start))
    link = F.coalesce(F.col("previous_hash") == before, F.lit(False))
    own = F.coalesce(F.col("event_hash") == event_hash(F.col("previous_hash"), F.col("payload")), F.lit(False))
    return log.withColumn("link_ok", link).withColumn("hash_ok", own)
