"""Sources and their citations in drafts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.functions import text as X
from stemma.operators.ordered import lines_of, numbered, outside_fences


def registered(urls: DataFrame, order: str) -> DataFrame:
    """``source_id, url``: each URL (by its normal form) once, numbered by first appearance."""
    first = urls.select(X.url_key("url").alias("url"), order).where("url is not null").groupBy("url").agg(F.min(order).alias("_o"))
    return numbered(first, ["_o", "url"], "source_id").select("source_id", "url")


def citation_check(drafts: DataFrame, listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """``doc_id, source_id, issue`` for cited, listed and known sources that do not agree.

    ``drafts``: ``doc_id, text``; ``listed``: ``doc_id, source_id, url`` (the draft's own list);
    ``ledger``: ``source_id, url``. Issues: ``unknown`` (not in the ledger), ``unlisted`` (cited, not
    listed), ``uncited`` (listed, not cited), ``url_mismatch``.
    """
    cited = drafts.select("doc_id", F.explode(X.citation_ids("text")).alias("source_id")).distinct().withColumn("c", F.lit(True))
    own = listed.select("doc_id", "source_id", X.url_key("url").alias("l_url"), F.lit(True).alias("l"))
    known = ledger.select("source_id", X.url_key("url").alias("k_url"), F.lit(True).alias("k"))
    j = cited.join(own, ["doc_id", "source_id"], "full_outer").join(known, "source_id", "left")
    issue = (
        F.when(F.col("k").isNull(), "unknown")
        .when(F.col("l").isNull(), "unlisted")
        .when(F.col("c").isNull(), "uncited")
        .when(~F.col("l_url").eqNullSafe(F.col("k_url")), "url_mismatch")
    )
    return j.select("doc_id", "source_id", issue.alias("issue")).where("issue is not null")


def coverage(drafts: DataFrame) -> DataFrame:
    """``doc_id, n_sentences, n_cited``: sentences outside code fences and headings, and those with a citation."""
    prose = outside_fences(lines_of(drafts.select("doc_id", "text")))
    prose = prose.where(~F.col("line").rlike(r"^\s*(#|\||>)"))
    sentence = prose.select("doc_id", F.explode(F.split("line", r"(?<=[.!?])\s+(?=[^\[])")).alias("s")).where(F.size(F.split(F.trim("s"), r"\s+")) >= 4)
    return sentence.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"), F.count_if(F.col("s").rlike(r"\[[0-9]+\]")).alias("n_cited"))
