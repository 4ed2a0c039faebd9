"""Registered queries of the training-data operators. None has SQL: canonical Unicode forms, Bloom
filters, message passing and tokenizers cannot be said in it; they are tested against brute force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stemma.llm import containment, copies, encoding, matching, people, spans, text_forms

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of copies of one record."""
    return copies.copy_pairs(copies.copy_groups(_table(spark, sf_dir, "papers")))


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record a paper with the number of its copies."""
    return copies.one_record_each(copies.copy_groups(_table(spark, sf_dir, "papers")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with a character that only imitates another."""
    return text_forms.imitating_values(_table(spark, sf_dir, "papers"), _table(spark, sf_dir, "authorships"))


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of one visible text, grouped by skeleton."""
    return text_forms.spelling_groups(text_forms.spelled_values(_table(spark, sf_dir, "papers"), _table(spark, sf_dir, "authorships")))


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.matches(_table(spark, sf_dir, "professors"), _table(spark, sf_dir, "departments"), _table(spark, sf_dir, "author_profiles"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two sources about the same person."""
    return _matches(spark, sf_dir).where(f"confidence > {matching.MATCH}").select("professor_id", "profile_id")


def p3_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidate pairs with their confidence."""
    from pyspark.sql import functions as F

    return _matches(spark, sf_dir).withColumn("confidence", F.round("confidence", 4))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the spellings of one person."""
    return people.author_links(_table(spark, sf_dir, "professors"), _table(spark, sf_dir, "departments"), _table(spark, sf_dir, "authorships"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row whose value survives for each field of each group of copies."""
    papers = _table(spark, sf_dir, "papers")
    return copies.survivors(papers, _table(spark, sf_dir, "harvest_sources"), copies.copy_groups(papers))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encoding.encoded(_table(spark, sf_dir, "documents"))


def p7_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by whether decoding their ids gives their text again: ``whole, n``."""
    from pyspark.sql import functions as F

    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    back = encoding.decoded(encoding.encoded(documents)).select("doc_id", F.xxhash64("text").alias("h"))
    there = documents.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h0"))
    return there.join(back, "doc_id").groupBy((F.col("h") == F.col("h0")).alias("whole")).agg(F.count(F.lit(1)).alias("n"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of a test item, with the item."""
    return containment.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents that share a span of 300 characters or more."""
    return spans.sharing_pairs(*spans.shared_spans(_table(spark, sf_dir, "documents")))


def p9_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document is shared elsewhere."""
    documents = _table(spark, sf_dir, "documents")
    return spans.shared_extent(documents, *spans.shared_spans(documents))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_records, p2_found, p2_groups, p3_found, p3_matches, p5_found, p6_found, p7_ids, p7_roundtrip, p8_found, p9_found, p9_extent)}


def oracle_sql() -> dict[str, str]:
    return {}
