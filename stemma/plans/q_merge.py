"""Queries over identity, merging and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import text as X
from stemma.operators import merge as M
from stemma.operators import ordered as O
from stemma.operators import quality as Q
from stemma.plans.tables import Tables

_TITLE = "nullif(trim(regexp_replace(regexp_replace(lower({c}), '[''\"’‘“”`]', '', 'g'), '[^a-z0-9]+', ' ', 'g')), '')"
_DOI = "nullif(regexp_replace(regexp_extract(lower({c}), '10\\.[0-9]{{4,9}}/[^\\s\"<>]+', 0), '[.,;]+$', ''), '')"


def identity_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity of each paper: by DOI, title and year, title, or itself."""
    t = Tables(spark, sf_dir)
    k = M.identity_key(F.col("doi"), F.col("title"), F.col("publication_year"), F.col("paper_id"))
    return t.papers.select("paper_id", k.alias("k")).select("paper_id", F.col("k.kind").alias("kind"), F.col("k.value").alias("identity"))


SQL_IDENTITY = f"""
WITH k AS (SELECT paper_id, publication_year, {_DOI.format(c="doi")} AS d, {_TITLE.format(c="title")} AS t FROM papers)
SELECT paper_id, CASE WHEN d IS NOT NULL THEN 'doi' WHEN t IS NOT NULL AND publication_year IS NOT NULL THEN 'title_year' WHEN t IS NOT NULL THEN 'title' ELSE 'record' END AS kind,
  CASE WHEN d IS NOT NULL THEN d WHEN t IS NOT NULL AND publication_year IS NOT NULL THEN t || '|' || publication_year WHEN t IS NOT NULL THEN t ELSE sha256(CAST(paper_id AS VARCHAR)) END AS identity FROM k
"""


def identity_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities that several papers share, with how many are surplus."""
    return Q.duplicate_groups(identity_keys(spark, sf_dir), ["kind", "identity"])


SQL_GROUPS = f"SELECT kind, identity, count(*) AS n, count(*) - 1 AS surplus FROM ({SQL_IDENTITY}) GROUP BY ALL HAVING count(*) > 1"


def surplus_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many papers are surplus, by kind of identity."""
    return identity_groups(spark, sf_dir).groupBy("kind").agg(F.count(F.lit(1)).alias("n_groups"), F.sum("surplus").alias("surplus"))


SQL_SURPLUS = f"SELECT kind, count(*) AS n_groups, CAST(sum(surplus) AS BIGINT) AS surplus FROM ({SQL_GROUPS}) GROUP BY kind"

_FIELDS = ("doi", "venue", "publisher", "abstract", "arxiv_id")


def first_nonempty_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers of one title and year merged: first non-blank value of each field, all kinds of status in order."""
    t = Tables(spark, sf_dir)
    rows = t.papers.withColumn("title_key", X.title_key("title")).withColumn("states", F.array("metadata_status"))
    out = M.merge_first(rows, ["title_key", "publication_year"], F.col("paper_id"), _FIELDS, ["states"])
    return out.withColumn("states", F.array_join("states", ","))


SQL_MERGE = f"""
WITH r AS (SELECT *, {_TITLE.format(c="title")} AS title_key FROM papers),
g AS (SELECT title_key, publication_year, {", ".join(f"arg_min({f}, paper_id) FILTER (WHERE trim({f}) <> '') AS {f}" for f in _FIELDS)}, count(*) AS n_merged FROM r GROUP BY title_key, publication_year),
s AS (SELECT title_key, publication_year, string_agg(metadata_status, ',' ORDER BY o) AS states FROM (SELECT title_key, publication_year, metadata_status, min(paper_id) AS o FROM r GROUP BY ALL) GROUP BY title_key, publication_year)
SELECT g.*, s.states FROM g JOIN s ON g.title_key IS NOT DISTINCT FROM s.title_key AND g.publication_year IS NOT DISTINCT FROM s.publication_year
"""


def ranked_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers of one title and year folded in order, where one with more citations becomes the base."""
    t = Tables(spark, sf_dir)
    rows = t.papers.withColumn("title_key", X.title_key("title"))
    return M.merge_ranked(rows, ["title_key", "publication_year"], F.col("paper_id"), F.coalesce("citation_count", F.lit(0)), ("doi", "venue", "publisher"))


SQL_RANKED = f"""
WITH r AS (SELECT *, {_TITLE.format(c="title")} AS title_key, coalesce(citation_count, 0) AS k FROM papers),
b AS (SELECT *, coalesce(k > max(k) OVER (PARTITION BY title_key, publication_year ORDER BY paper_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS base FROM r),
o AS (SELECT *, (CASE WHEN base THEN 0 ELSE 1 END) * 1000000000000 + CASE WHEN base THEN -paper_id ELSE paper_id END AS p FROM b)
SELECT title_key, publication_year, arg_min(doi, p) FILTER (WHERE trim(doi) <> '') AS doi, arg_min(venue, p) FILTER (WHERE trim(venue) <> '') AS venue,
  arg_min(publisher, p) FILTER (WHERE trim(publisher) <> '') AS publisher, max(k) AS rank, count(*) AS n_merged FROM o GROUP BY title_key, publication_year
"""


def surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable ids of titles in first-seen order."""
    t = Tables(spark, sf_dir)
    keys = t.papers.groupBy(X.title_key("title").alias("title_key"), "publication_year").agg(F.min("paper_id").alias("first_id"))
    return O.surrogate_ids(keys, ["first_id"]).select("id", "title_key", "publication_year", "first_id")


SQL_SURROGATE = f"""
WITH k AS (SELECT {_TITLE.format(c="title")} AS title_key, publication_year, min(paper_id) AS first_id FROM papers GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (ORDER BY first_id) AS r FROM k)
SELECT 'PUB-' || CASE WHEN r < 100000 THEN lpad(CAST(r AS VARCHAR), 5, '0') ELSE CAST(r AS VARCHAR) END AS id, title_key, publication_year, first_id FROM n
"""


def canonical_authorships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a professor and paper: the first occurrence and how many there were."""
    t = Tables(spark, sf_dir)
    rows = t.authorships.where("professor_id is not null").select("authorship_id", "professor_id", "paper_id", "author_position").distinct()
    return M.canonical_links(rows, ["professor_id", "paper_id"], F.col("authorship_id"), ["authorship_id", "author_position"])


SQL_CANONICAL = """
WITH r AS (SELECT DISTINCT authorship_id, professor_id, paper_id, author_position FROM authorships WHERE professor_id IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY professor_id, paper_id ORDER BY authorship_id) AS k, count(*) OVER (PARTITION BY professor_id, paper_id) AS n_occurrences FROM r)
SELECT professor_id, paper_id, authorship_id, author_position, n_occurrences FROM n WHERE k = 1
"""


def coalesce_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles upserted into professors by ORCID cell: existing values win, the place is taken from the profile."""
    t = Tables(spark, sf_dir)
    existing = t.professors.where("orcid <> ''").groupBy("orcid").agg(F.min("full_name").alias("name"), F.min("institution").alias("place"), F.min("semantic_scholar_id").alias("scholar"))
    incoming = t.author_profiles.where("orcid <> ''").groupBy("orcid").agg(F.min("display_name").alias("name"), F.min("affiliation").alias("place"), F.min("scholar_ref").alias("scholar"))
    return M.upsert(existing, incoming, ["orcid"], ["place"])


SQL_UPSERT = """
WITH a AS (SELECT orcid, min(full_name) AS name, min(institution) AS place, min(semantic_scholar_id) AS scholar FROM professors WHERE orcid <> '' GROUP BY orcid),
b AS (SELECT orcid, min(display_name) AS name, min(affiliation) AS place, min(scholar_ref) AS scholar FROM author_profiles WHERE orcid <> '' GROUP BY orcid)
SELECT coalesce(a.orcid, b.orcid) AS orcid, coalesce(a.name, b.name) AS name, coalesce(b.place, a.place) AS place, coalesce(a.scholar, b.scholar) AS scholar,
  CASE WHEN a.orcid IS NULL THEN 'inserted' WHEN b.orcid IS NOT NULL AND (coalesce(a.name, b.name) IS DISTINCT FROM a.name OR coalesce(b.place, a.place) IS DISTINCT FROM a.place OR coalesce(a.scholar, b.scholar) IS DISTINCT FROM a.scholar) THEN 'updated' ELSE 'kept' END AS change
FROM a FULL JOIN b ON a.orcid = b.orcid
"""


def nullsafe_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document records upserted into papers by title key and year, where no year equals no year."""
    t = Tables(spark, sf_dir)
    p = t.papers.withColumn("title_key", X.title_key("title"))
    existing = p.where("trim(source_name) <> ''").groupBy("title_key", "publication_year").agg(F.max("doi").alias("doi"), F.max("venue").alias("venue"))
    incoming = p.where("source_name is null or trim(source_name) = ''").groupBy("title_key", "publication_year").agg(F.max("doi").alias("doi"), F.max("venue").alias("venue"))
    return M.upsert(existing, incoming, ["title_key", "publication_year"])


SQL_NULLSAFE = f"""
WITH p AS (SELECT *, {_TITLE.format(c="title")} AS title_key FROM papers),
a AS (SELECT title_key, publication_year, max(doi) AS doi, max(venue) AS venue, true AS x FROM p WHERE trim(source_name) <> '' GROUP BY 1, 2),
b AS (SELECT title_key, publication_year, max(doi) AS doi, max(venue) AS venue, true AS x FROM p WHERE source_name IS NULL OR trim(source_name) = '' GROUP BY 1, 2)
SELECT CASE WHEN a.x THEN a.title_key ELSE b.title_key END AS title_key, CASE WHEN a.x THEN a.publication_year ELSE b.publication_year END AS publication_year,
  coalesce(a.doi, b.doi) AS doi, coalesce(a.venue, b.venue) AS venue,
  CASE WHEN a.x IS NULL THEN 'inserted' WHEN b.x AND (coalesce(a.doi, b.doi) IS DISTINCT FROM a.doi OR coalesce(a.venue, b.venue) IS DISTINCT FROM a.venue) THEN 'updated' ELSE 'kept' END AS change
FROM a FULL JOIN b ON a.title_key IS NOT DISTINCT FROM b.title_key AND a.publication_year IS NOT DISTINCT FROM b.publication_year
"""


def doubled_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authorships that were delivered more than once: an upsert by their id would be ambiguous."""
    return M.doubled(Tables(spark, sf_dir).authorships, ["authorship_id"])


SQL_DOUBLED = "SELECT authorship_id, count(*) AS n FROM authorships GROUP BY 1 HAVING count(*) > 1"


def first_seen_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First document of each text."""
    t = Tables(spark, sf_dir)
    return O.first_seen(t.documents.where("text is not null").select("text", "doc_id", "source"), ["text"], F.col("doc_id")).select("doc_id", "source")


SQL_FIRST = "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents WHERE text IS NOT NULL) WHERE k = 1"

QUERIES = {
    f.__name__: f
    for f in (identity_keys, identity_groups, surplus_total, first_nonempty_merge, ranked_merge, surrogate_ids, canonical_authorships, coalesce_upsert, nullsafe_upsert, doubled_keys, first_seen_documents)
}
SQL = {
    "identity_keys": SQL_IDENTITY, "identity_groups": SQL_GROUPS, "surplus_total": SQL_SURPLUS, "first_nonempty_merge": SQL_MERGE, "ranked_merge": SQL_RANKED, "surrogate_ids": SQL_SURROGATE,
    "canonical_authorships": SQL_CANONICAL, "coalesce_upsert": SQL_UPSERT, "nullsafe_upsert": SQL_NULLSAFE, "doubled_keys": SQL_DOUBLED, "first_seen_documents": SQL_FIRST,
}
