"""Values packed in one field."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.operators.packed import unpacked

FIELDS = (("papers", "keywords", "paper_id"), ("papers", "research_topics", "paper_id"), ("professors", "research_interests", "professor_id"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = [spark.read.parquet(f"{sf_dir}/{t}.parquet").select(F.lit(f"{t}.{c}").alias("field_name"), F.col(i).cast("bigint").alias("row_id"), F.col(c).alias("cell")) for t, c, i in FIELDS]
    return unpacked(reduce(DataFrame.unionByName, cells))


QUERIES = {"p4_found": p4_found}
SQL: dict[str, str] = {}
