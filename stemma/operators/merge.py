"""Identity keys, merging of records of one identity, and upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.functions import text as X
from stemma.operators.joins import null_safe
from stemma.operators.ordered import first_value
from stemma.session import removed


def identity_key(doi: Column, title: Column, year: Column, record: Column, merge_undated: bool = True) -> Column:
    """Struct ``kind, value``: DOI, else title and year, else title alone, else the record itself.

    Without ``merge_undated`` an undated title is no identity. A record without a DOI and a title is
    never merged; its value is its hash.
    """
    d, t = X.doi(doi), X.title_key(title)

    def arm(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    arms = F.when(d.isNotNull(), arm("doi", d)).when(t.isNotNull() & year.isNotNull(), arm("title_year", F.concat(t, F.lit("|"), year.cast("string"))))
    if merge_undated:
        arms = arms.when(t.isNotNull(), arm("title", t))
    return arms.otherwise(arm("record", F.sha2(record.cast("string"), 256)))


def merge_first(df: DataFrame, keys: Sequence[str], order: Column, fields: Sequence[str], lists: Sequence[str] = ()) -> DataFrame:
    """One row a key: of each field the first non-blank value in order; of each list the ordered union.

    Also ``n_merged``. All in one aggregation with partial sums on the map side.
    """
    agg = [first_value(F.col(f), order).alias(f) for f in fields]
    for f in lists:
        parts = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col(f).alias("v"))))
        agg.append(F.array_distinct(F.flatten(F.transform(parts, lambda x: F.coalesce(x["v"], F.array())))).alias(f))
    return df.groupBy(*keys).agg(*agg, F.count(F.lit(1)).alias("n_merged"))


def merge_ranked(df: DataFrame, keys: Sequence[str], order: Column, rank: Column, fields: Sequence[str]) -> DataFrame:
    """As a fold over the records in order, in which a record of strictly higher rank becomes the
    base and the other fills its blanks: new bases go before all earlier records, the others behind.
    """
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = df.withColumn("_o", order).withColumn("_r", rank)
    ranked = ranked.withColumn("_base", F.coalesce(F.col("_r") > F.max("_r").over(before), F.lit(True)))
    precedence = F.struct((~F.col("_base")).alias("a"), F.when(F.col("_base"), -F.col("_o")).otherwise(F.col("_o")).alias("b"))
    return ranked.groupBy(*keys).agg(*(first_value(F.col(f), precedence).alias(f) for f in fields), F.max("_r").alias("rank"), F.count(F.lit(1)).alias("n_merged"))


def canonical_links(rows: DataFrame, keys: Sequence[str], order: Column, keep: Sequence[str]) -> DataFrame:
    """One row a key: the first row's columns and the number of occurrences."""
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*keep), order).alias("_f"), F.count(F.lit(1)).alias("n_occurrences")).select(*keys, "_f.*", "n_occurrences")


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], incoming_wins: Sequence[str] = ()) -> DataFrame:
    """``existing`` with the new keys of ``incoming``, and its blanks filled: existing values win.

    Keys are compared null-safe. Columns in ``incoming_wins`` are taken from ``incoming`` where it
    has a value. Both sides must have unique keys (see ``doubled``). ``change`` says ``kept``,
    ``updated`` or ``inserted``.
    """
    values = [c for c in existing.columns if c not in keys]
    a = existing.select(*(F.col(c).alias(f"_a_{c}") for c in existing.columns), F.lit(True).alias("_a"))
    b = incoming.select(*(F.col(c).alias(f"_b_{c}") for c in existing.columns), F.lit(True).alias("_b"))
    j = a.join(b, null_safe([F.col(f"_a_{k}") for k in keys], [F.col(f"_b_{k}") for k in keys]), "full_outer")
    new = {k: F.when(F.col("_a"), F.col(f"_a_{k}")).otherwise(F.col(f"_b_{k}")) for k in keys}
    new |= {c: F.coalesce(f"_b_{c}", f"_a_{c}") if c in incoming_wins else F.coalesce(f"_a_{c}", f"_b_{c}") for c in values}
    moved = reduce(lambda x, y: x | y, (~new[c].eqNullSafe(F.col(f"_a_{c}")) for c in values), F.lit(False))
    change = F.when(F.col("_a").isNull(), "inserted").when(F.col("_b").isNotNull() & moved, "updated").otherwise("kept")
    return j.select(*(new[c].alias(c) for c in existing.columns), change.alias("change"))


def doubled(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number: they must be none before an upsert."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside the table, then put it in its place, so that a failed write leaves the old one."""
    spark = df.sparkSession
    fresh, old = f"{path}.new", f"{path}.old"
    removed(spark, fresh)
    df.write.parquet(fresh)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed(spark, old)
    if fs.exists(at):
        fs.rename(at, jvm.org.apache.hadoop.fs.Path(old))
    fs.rename(jvm.org.apache.hadoop.fs.Path(fresh), at)
    removed(spark, old)
