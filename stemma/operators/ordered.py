"""Order-dependent operators: numbering, first values, ordered lists, pairing of occurrences, lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.session import written


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """``df`` with its place in the total order, from 1, without a one-task sort.

    Rows are range-partitioned and kept as a table (so that the split is the same when read again),
    numbered within each part, and moved by the sizes of the parts before, of which there is one
    number a part. Rows equal in the order are numbered in any order: give a full order.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    split = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    kept = written(split.withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    at = F.row_number().over(Window.partitionBy("_part").orderBy(*cols))
    return kept.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + at).drop("_part", "_before")


def surrogate_ids(df: DataFrame, order: Sequence[Column | str], prefix: str = "PUB", width: int = 5) -> DataFrame:
    """``df`` with ``id`` such as ``PUB-00001`` in first-seen order."""
    return numbered(df, order).withColumn("id", F.concat(F.lit(f"{prefix}-"), F.lpad("ordinal", F.greatest(F.lit(width), F.length(F.col("ordinal").cast("string"))), F.lit("0"))))


def first_value(value: Column, order: Column, present: Column | None = None) -> Column:
    """Aggregate: the first present value in order (present: neither null nor blank)."""
    ok = present if present is not None else value.isNotNull() & (F.trim(value.cast("string")) != "")
    return F.min_by(F.when(ok, value), F.when(ok, order))


def ordered_list(value: Column, order: Sequence[Column], keep: Column | None = None) -> Column:
    """Aggregate: values in order, nulls of the order last; an empty list if there is none."""
    keys = [F.struct(o.isNull().alias("n"), o.alias("o")).alias(f"k{i}") for i, o in enumerate(order)]
    item = F.struct(*keys, value.alias("v"))
    items = F.collect_list(F.when(keep, item) if keep is not None else item)
    return F.transform(F.array_sort(items), lambda x: x["v"])


def kth_pairs(left: DataFrame, right: DataFrame, on: Sequence[str], left_order: Sequence[Column | str], right_order: Sequence[Column | str]) -> DataFrame:
    """The k-th row of a key on the left with the k-th row of that key on the right.

    Full outer: ``l`` and ``r`` are structs of the rows, one of them null where a side has more rows
    (an occurrence without its decision). Null keys are paired too.
    """
    a = left.withColumn("_k", F.row_number().over(Window.partitionBy(*on).orderBy(*left_order)))
    b = right.withColumn("_k", F.row_number().over(Window.partitionBy(*on).orderBy(*right_order)))
    a = a.select(*(F.col(c).alias(f"_a_{c}") for c in on), F.col("_k").alias("_ka"), F.struct(*left.columns).alias("l"))
    b = b.select(*(F.col(c).alias(f"_b_{c}") for c in on), F.col("_k").alias("_kb"), F.struct(*right.columns).alias("r"))
    cond = F.col("_ka") == F.col("_kb")
    for c in on:
        cond &= F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}"))
    out = a.join(b, cond, "full_outer")
    return out.select(*(F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in on), F.coalesce("_ka", "_kb").alias("k"), "l", "r")


def lines_of(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row a line: ``keep``, ``line_no`` from 1, ``line``. Null texts have none."""
    return df.select(*keep, F.posexplode(F.split(F.col(text), r"\r?\n")).alias("p", "line")).select(*keep, (F.col("p") + 1).alias("line_no"), "line")


def section_of(lines: DataFrame, heading: Column, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Lines with ``section``, the text of the last heading at or before the line."""
    w = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("section", F.last(F.when(heading, F.trim("line")), ignorenulls=True).over(w))


def after_last_heading(lines: DataFrame, heading: Column, end: Column, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Lines after the last line that is ``heading``, up to the first ``end`` line behind it."""
    w = Window.partitionBy(*keys)
    marked = lines.withColumn("_start", F.max(F.when(heading, F.col("line_no"))).over(w))
    marked = marked.withColumn("_stop", F.min(F.when(end & (F.col("line_no") > F.col("_start")), F.col("line_no"))).over(w))
    inside = (F.col("line_no") > F.col("_start")) & (F.col("_stop").isNull() | (F.col("line_no") < F.col("_stop")))
    return marked.where(inside).drop("_start", "_stop")


def outside_fences(lines: DataFrame, keys: Sequence[str] = ("doc_id",), fence: str = r"^\s*```") -> DataFrame:
    """Lines outside code fences (running parity of fence lines)."""
    w = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    is_fence = F.coalesce(F.col("line").rlike(fence), F.lit(False))
    return lines.withColumn("_n", F.sum(is_fence.cast("int")).over(w)).where((F.col("_n") % 2 == 0) & ~is_fence).drop("_n")


def joined_items(lines: DataFrame, starts: Column, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Lines joined to items: ``starts`` begins a new one; a hyphen at a line's end is undone.

    ``keys, item_no, item``. Lines before the first start form item 0.
    """
    w = Window.partitionBy(*keys).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    numbered_ = lines.withColumn("item_no", F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(w))
    parts = numbered_.groupBy(*keys, "item_no").agg(ordered_list(F.trim("line"), [F.col("line_no")]).alias("parts"))
    join = F.aggregate("parts", F.lit(""), lambda acc, x: F.when(acc == "", x).when(acc.rlike(r"\w-$") & x.rlike("^[a-z]"), F.concat(F.regexp_replace(acc, "-$", ""), x)).otherwise(F.concat(acc, F.lit(" "), x)))
    return parts.select(*keys, F.col("item_no").cast("bigint").alias("item_no"), join.alias("item"))


def top_by(df: DataFrame, order: Sequence[Column], n: int, within: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows, of the whole or of each group, in order."""
    if not within:
        return df.orderBy(*order).limit(n)
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def first_seen(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row a key: the first in order."""
    row = F.min_by(F.struct(*df.columns), order).alias("r")
    return df.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(row).select("r.*")
