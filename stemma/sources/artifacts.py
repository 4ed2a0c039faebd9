"""Readers and writers of JSON artifacts, landed answers, logs, delimited files and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemma.functions.text import cell_text


def read_artifact(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON document a file, with a declared schema (nothing is inferred)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_artifact(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def landed(spark: SparkSession, path: str) -> DataFrame:
    """``file, body`` of landed answers, one a file; the fetching itself is no part of the engine."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("body"))


def parsed(body: Column) -> Column:
    """The answer as a variant; JSON that was encoded once more inside a JSON string is unwrapped."""
    v = F.try_parse_json(body)
    return F.try_parse_json(F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))


def as_list(v: Column) -> Column:
    """A variant that is a list, or a single value, as a list of JSON texts; null and missing give an empty one."""
    j = F.to_json(v)
    return F.when(v.isNull() | (j == "null"), F.array().cast("array<string>")).when(F.schema_of_variant(v).startswith("ARRAY"), F.from_json(j, "array<string>")).otherwise(F.array(j))


def pages(df: DataFrame, list_path: str, total_path: str) -> tuple[DataFrame, DataFrame]:
    """``(items, counts)`` of landed pages (``body``): all their items, and ``n_items, n_expected`` to be compared."""
    v = df.select(F.try_parse_json("body").alias("v"))
    items = v.select(F.explode(as_list(F.try_variant_get("v", list_path, "variant"))).alias("item"))
    expected = v.agg(F.max(F.try_variant_get("v", total_path, "bigint")).alias("n_expected"))
    return items, items.agg(F.count(F.lit(1)).alias("n_items")).crossJoin(expected)


def index_value(entries: Column, key: str) -> Column:
    """First value of a key in a list of ``struct<key, text, entry_key>``; the entry's own key where it has no text."""
    hit = F.get(F.filter(entries, lambda x: x["key"] == key), 0)
    return F.coalesce(F.nullif(hit["text"], F.lit("")), hit["entry_key"])


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, value`` of text files, lines from 1, blank ones counted.

    Large files are read in blocks by many tasks: a line's number is its place in its block, moved by
    the number of lines in the file's blocks before it, of which there is one number a block.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i"), "value")
    blocks = raw.groupBy(F.col("file").alias("b_file"), F.col("block").alias("b_block")).agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("b_file").orderBy("b_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("before", F.coalesce(before, F.lit(0)))
    at = raw.join(blocks, (F.col("file") == F.col("b_file")) & (F.col("block") == F.col("b_block")))
    return at.select("file", (F.col("before") + F.col("i") - F.col("first") + 1).alias("line"), "value")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with ``file``, ``line`` (their number) and ``bad`` (the text of lines that are no JSON). Blank lines are left out."""
    rows = numbered_lines(spark, path).where(F.trim("value") != "").withColumn("r", F.from_json("value", schema, {"mode": "PERMISSIVE"}))
    broken = F.try_parse_json("value").isNull()
    return rows.select("file", "line", "r.*", F.when(broken, F.col("value")).alias("bad"))


def append_log(df: DataFrame, path: str) -> None:
    """Append events; one writer at a time (Spark has no lock)."""
    df.write.mode("append").json(path)


def read_delimited(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """All columns as text: kinds are found cell by cell, see ``functions.text.coerced``."""
    return spark.read.option("sep", sep).option("encoding", encoding).option("header", header).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Timestamps at midnight are written as dates."""
    cols = [cell_text(c).alias(c) if kind.startswith("timestamp") else F.col(c).cast("string").alias(c) for c, kind in df.dtypes]
    df.select(*cols).write.mode("overwrite").option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``year, title`` of lines ``year|title``; a title may hold further bars."""
    p = F.split("value", r"\|", 2)
    return spark.read.text(path).where(F.trim("value") != "").select(F.trim(p[0]).try_cast("int").alias("year"), F.trim(p[1]).alias("title"))


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, length, modified`` of files below a folder, in order of their paths, each once."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return df.select("path", "length", F.col("modificationTime").alias("modified")).distinct().orderBy("path")


def file_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, sha256`` of files."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return df.select("path", F.sha2("content", 256).alias("sha256"))


def read_table(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A query on a database by JDBC, in parallel if ``partition`` names column, bounds and number."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q")
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition:
        column, low, high, n = partition
        r = r.option("partitionColumn", column).option("lowerBound", low).option("upperBound", high).option("numPartitions", n)
    return r.load()


def created(spark: SparkSession, statements: Sequence[str]) -> None:
    """Run ``CREATE TABLE IF NOT EXISTS`` statements all or not at all: if one fails, the tables made by those before it are dropped."""
    before = {t.name for t in spark.catalog.listTables()}
    try:
        for s in statements:
            spark.sql(s)
    except Exception:
        for t in spark.catalog.listTables():
            if t.name not in before and not t.isTemporary:
                spark.sql(f"DROP TABLE IF EXISTS `{t.name}`")
        raise


def batched(df: DataFrame, order: Sequence[str], size: int = 10) -> DataFrame:
    """``df`` with ``batch`` and ``batch_place``, both from 1: groups of ``size`` rows in order, for a sink that takes so many."""
    from stemma.operators.ordered import numbered

    n = numbered(df, list(order), "_n")
    return n.withColumn("batch", F.ceil(F.col("_n") / size).cast("bigint")).withColumn("batch_place", (F.pmod(F.col("_n") - 1, F.lit(size)) + 1).cast("int")).drop("_n")
