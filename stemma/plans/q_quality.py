"""Queries over counts, profiles, sets and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import text as X
from stemma.operators import ordered as O
from stemma.operators import quality as Q
from stemma.plans.tables import Tables

_TABLES = ("papers", "professors", "authorships", "departments", "topics", "documents", "ingestion_runs", "author_profiles")


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each ledger table."""
    t = Tables(spark, sf_dir)
    return Q.table_counts({n: getattr(t, n) for n in _TABLES})


SQL_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in _TABLES)


def group_having_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folded institutions of authorships that several rows share, among those of departments."""
    t = Tables(spark, sf_dir)
    known = t.departments.select(F.lower(F.trim("institution")).alias("place")).distinct()
    rows = t.authorships.select(F.lower(F.trim("institution")).alias("place")).join(known, "place", "left_semi")
    return Q.frequency(rows, "place").where("n > 1")


SQL_HAVING = "SELECT lower(trim(institution)) AS place, count(*) AS n FROM authorships WHERE lower(trim(institution)) IN (SELECT lower(trim(institution)) FROM departments) GROUP BY 1 HAVING count(*) > 1"


def completeness_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Present and missing values of every column of papers."""
    return Q.completeness(Tables(spark, sf_dir).papers)


_PAPER = "paper_id title abstract publication_year publication_date venue publisher doi isbn arxiv_id pmid publication_url legitimate_pdf_url keywords research_topics citation_count source_name source_url metadata_status full_text_status local_pdf_path lightrag_track_id lightrag_status discovered_at updated_at".split()
_TEXT = set("title abstract venue publisher doi isbn arxiv_id pmid publication_url legitimate_pdf_url keywords research_topics source_name source_url metadata_status full_text_status local_pdf_path lightrag_track_id lightrag_status".split())
SQL_COMPLETE = " UNION ALL ".join(
    f"SELECT '{c}' AS field, count(*) FILTER (WHERE {w}) AS present, count(*) - count(*) FILTER (WHERE {w}) AS missing, round(100.0 * count(*) FILTER (WHERE {w}) / count(*), 1) AS percent FROM papers"
    for c in _PAPER
    for w in [f"regexp_replace({c}, '^[\\s\\x{{00a0}}\\x{{3000}}]+', '') <> ''" if c in _TEXT else f"{c} IS NOT NULL"]
)


def freq_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion runs by status as written."""
    return Q.frequency(Tables(spark, sf_dir).ingestion_runs, "status")


def two_level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion runs by parser and folded status."""
    return Q.frequency(Tables(spark, sf_dir).ingestion_runs, "parser", F.lower(F.trim("status")).alias("state"))


def conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts under several conditions in one pass over papers."""
    doi = X.doi("doi")
    return Tables(spark, sf_dir).papers.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(doi.isNotNull()).alias("n_doi"),
        F.count_if(F.col("publication_year").isNull()).alias("n_undated"),
        F.count_if(X.is_url("publication_url")).alias("n_url"),
        F.count_distinct(F.coalesce(doi, F.concat_ws("|", X.title_key("title"), F.coalesce(F.col("publication_year").cast("string"), F.lit("?"))))).alias("n_distinct"),
    )


SQL_CONDITIONAL = r"""
WITH p AS (SELECT *, nullif(regexp_replace(regexp_extract(lower(doi), '10\.[0-9]{4,9}/[^\s"<>]+', 0), '[.,;]+$', ''), '') AS d,
  nullif(trim(regexp_replace(regexp_replace(lower(title), '[''"’‘“”`]', '', 'g'), '[^a-z0-9]+', ' ', 'g')), '') AS t FROM papers)
SELECT count(*) AS n, count(d) AS n_doi, count(*) FILTER (WHERE publication_year IS NULL) AS n_undated, count(*) FILTER (WHERE regexp_matches(publication_url, '(?i)^\s*https?://')) AS n_url,
  count(DISTINCT coalesce(d, concat_ws('|', t, coalesce(CAST(publication_year AS VARCHAR), '?')))) AS n_distinct FROM p
"""


def per_parent_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors of each paper, and the sum and distinct number of their names."""
    t = Tables(spark, sf_dir)
    a = t.authorships.select("authorship_id", "paper_id", "author_name_as_published", "author_position").distinct()
    return a.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_authors"), F.count_distinct("author_name_as_published").alias("n_names"), F.min("author_position").alias("first_position"))


SQL_PARENT = "SELECT paper_id, count(*) AS n_authors, count(DISTINCT author_name_as_published) AS n_names, min(author_position) AS first_position FROM (SELECT DISTINCT authorship_id, paper_id, author_name_as_published, author_position FROM authorships) GROUP BY paper_id"


def distinct_set_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Professors of each paper as a sorted list without repeats."""
    t = Tables(spark, sf_dir)
    a = t.authorships.where("professor_id is not null").select("paper_id", "professor_id").distinct()
    return a.groupBy("paper_id").agg(F.array_join(F.transform(F.array_sort(F.collect_set("professor_id")), lambda x: x.cast("string")), ",").alias("professors"))


SQL_SETS = "SELECT paper_id, string_agg(CAST(professor_id AS VARCHAR), ',' ORDER BY professor_id) AS professors FROM (SELECT DISTINCT paper_id, professor_id FROM authorships WHERE professor_id IS NOT NULL) GROUP BY paper_id"


def flattened_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of all embeddings by label: their number, and the number of different vectors."""
    e = Tables(spark, sf_dir).embeddings
    return e.groupBy("label").agg(F.sum(F.size("embedding")).alias("n_elements"), F.count_distinct("vec_id").alias("n_vectors"))


SQL_FLAT = "SELECT label, CAST(sum(len(embedding)) AS BIGINT) AS n_elements, count(DISTINCT vec_id) AS n_vectors FROM embeddings GROUP BY label"


def unmatched_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source names of papers that are no harvest source, with how often they occur."""
    t = Tables(spark, sf_dir)
    return Q.frequency(t.papers.where("source_name is not null").join(t.harvest_sources.select("source_name"), "source_name", "left_anti"), "source_name")


SQL_UNMATCHED = "SELECT source_name, count(*) AS n FROM papers WHERE source_name IS NOT NULL AND source_name NOT IN (SELECT source_name FROM harvest_sources) GROUP BY source_name"


def expected_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by type: how many have a finished run, and how many are still expected to."""
    t = Tables(spark, sf_dir)
    done = t.ingestion_runs.where("completed_at is not null and document_id is not null").select(F.col("document_id").alias("doc_id"), F.lit(True).alias("ok")).distinct()
    return t.documents.select("doc_id", "document_type").distinct().join(done, "doc_id", "left").groupBy("document_type").agg(F.count("ok").alias("n_done"), F.count_if(F.col("ok").isNull()).alias("n_open"))


SQL_TALLIES = """
SELECT document_type, count(r.document_id) AS n_done, count(*) - count(r.document_id) AS n_open FROM (SELECT DISTINCT doc_id, document_type FROM documents) d
LEFT JOIN (SELECT DISTINCT document_id FROM ingestion_runs WHERE completed_at IS NOT NULL) r ON r.document_id = d.doc_id GROUP BY document_type
"""


def set_diff_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Institutions that only professors or only authorships name."""
    t = Tables(spark, sf_dir)
    return Q.difference(t.professors.select("institution"), t.authorships.select("institution"), ["institution"])


SQL_DIFF = """
SELECT institution, 'missing' AS side FROM (SELECT institution FROM professors EXCEPT SELECT institution FROM authorships)
UNION ALL SELECT institution, 'extra' AS side FROM (SELECT institution FROM authorships EXCEPT SELECT institution FROM professors)
"""


def changed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that lose rows when repeated rows are dropped."""
    t = Tables(spark, sf_dir)
    names = ("authorships", "ingestion_runs", "papers")
    before = Q.table_counts({n: getattr(t, n) for n in names})
    return Q.changed_counts(before, Q.table_counts({n: getattr(t, n).distinct() for n in names}))


SQL_CHANGED = " UNION ALL ".join(f"SELECT * FROM (SELECT '{n}' AS table_name, (SELECT count(*) FROM {n}) AS n_before, (SELECT count(*) FROM (SELECT DISTINCT * FROM {n})) AS n_after) WHERE n_before <> n_after" for n in ("authorships", "ingestion_runs", "papers"))


def integrity_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over the ledger, one row each."""
    t = Tables(spark, sf_dir)
    checks = [
        Q.checked("authorship_paper", t.authorships.join(t.papers.select("paper_id"), "paper_id", "left_anti")),
        Q.checked("authorship_professor", t.authorships.where("professor_id is not null").join(t.professors.select("professor_id"), "professor_id", "left_anti")),
        Q.checked("topic_parent", t.topics.where("parent_topic_id is not null").join(t.topics.select(F.col("topic_id").alias("parent_topic_id")), "parent_topic_id", "left_anti")),
        Q.checked("authorship_unique", t.authorships.groupBy("authorship_id").count().where("count > 1")),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


SQL_CHECKS = " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, count(*) = 0 AS ok, count(*) AS n_bad FROM ({q})"
    for n, q in (
        ("authorship_paper", "SELECT 1 FROM authorships WHERE paper_id NOT IN (SELECT paper_id FROM papers)"),
        ("authorship_professor", "SELECT 1 FROM authorships WHERE professor_id IS NOT NULL AND professor_id NOT IN (SELECT professor_id FROM professors)"),
        ("topic_parent", "SELECT 1 FROM topics WHERE parent_topic_id IS NOT NULL AND parent_topic_id NOT IN (SELECT topic_id FROM topics)"),
        ("authorship_unique", "SELECT 1 FROM authorships GROUP BY authorship_id HAVING count(*) > 1"),
    )
)


def quality_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of each paper's DOI and URL, the first fault, and all faults."""
    p = Tables(spark, sf_dir).papers
    own = X.doi("doi")
    recovered = X.recovered_doi("publication_url", "source_url")
    doi_state = Q.first_reason([("original", own.isNotNull()), ("recovered", recovered.isNotNull())], "missing")
    url_state = Q.first_reason([("valid", X.is_full_url("publication_url")), ("suspicious", F.trim("publication_url") != "")], "missing")
    rules = [("undated", F.col("publication_year").isNull()), ("no_doi", own.isNull()), ("no_abstract", F.coalesce(F.trim("abstract") == "", F.lit(True)))]
    return p.select("paper_id", doi_state.alias("doi_state"), url_state.alias("url_state"), Q.first_reason(rules, "none").alias("first_fault"), F.array_join(Q.warnings(rules), ",").alias("faults"))


SQL_QUALITY = r"""
WITH p AS (SELECT *, nullif(regexp_replace(regexp_extract(lower(doi), '10\.[0-9]{4,9}/[^\s"<>]+', 0), '[.,;]+$', ''), '') AS d,
  coalesce(nullif(regexp_extract(lower(publication_url), '10\.[0-9]{4,9}/[^\s"<>]+', 0), ''), nullif(regexp_extract(lower(source_url), '10\.[0-9]{4,9}/[^\s"<>]+', 0), '')) AS u FROM papers)
SELECT paper_id, CASE WHEN d IS NOT NULL THEN 'original' WHEN u IS NOT NULL THEN 'recovered' ELSE 'missing' END AS doi_state,
  CASE WHEN regexp_matches(publication_url, '(?i)^\s*https?://[^/\s?#]+') THEN 'valid' WHEN trim(publication_url) <> '' THEN 'suspicious' ELSE 'missing' END AS url_state,
  CASE WHEN publication_year IS NULL THEN 'undated' WHEN d IS NULL THEN 'no_doi' WHEN coalesce(trim(abstract) = '', true) THEN 'no_abstract' ELSE 'none' END AS first_fault,
  concat_ws(',', CASE WHEN publication_year IS NULL THEN 'undated' END, CASE WHEN d IS NULL THEN 'no_doi' END, CASE WHEN coalesce(trim(abstract) = '', true) THEN 'no_abstract' END) AS faults FROM p
"""


def newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents added last: a report, so the limit is its feature."""
    d = Tables(spark, sf_dir).documents
    return O.top_by(d.select("doc_id", "document_type", "created_at"), [F.desc_nulls_last("created_at"), F.col("doc_id")], 10).select("doc_id", "document_type")


SQL_NEWEST = "SELECT doc_id, document_type FROM documents ORDER BY created_at DESC NULLS LAST, doc_id LIMIT 10"


def top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most cited papers of each year."""
    p = Tables(spark, sf_dir).papers.select("publication_year", "paper_id", "citation_count")
    return O.top_by(p, [F.desc_nulls_last("citation_count"), F.col("paper_id")], 3, ["publication_year"])


SQL_TOP = "SELECT publication_year, paper_id, citation_count FROM papers QUALIFY row_number() OVER (PARTITION BY publication_year ORDER BY citation_count DESC NULLS LAST, paper_id) <= 3"

QUERIES = {
    f.__name__: f
    for f in (
        table_counts, group_having_dups, completeness_profile, freq_desc, two_level_counts, conditional_counts, per_parent_counts, distinct_set_per_group, flattened_sums, unmatched_frequency,
        expected_tallies, set_diff_both, changed_counts, integrity_checks, quality_case, newest_first, top_per_group,
    )
}
SQL = {
    "table_counts": SQL_COUNTS, "group_having_dups": SQL_HAVING, "completeness_profile": SQL_COMPLETE, "freq_desc": "SELECT status, count(*) AS n FROM ingestion_runs GROUP BY status",
    "two_level_counts": "SELECT parser, lower(trim(status)) AS state, count(*) AS n FROM ingestion_runs GROUP BY 1, 2", "conditional_counts": SQL_CONDITIONAL, "per_parent_counts": SQL_PARENT,
    "distinct_set_per_group": SQL_SETS, "flattened_sums": SQL_FLAT, "unmatched_frequency": SQL_UNMATCHED, "expected_tallies": SQL_TALLIES, "set_diff_both": SQL_DIFF, "changed_counts": SQL_CHANGED,
    "integrity_checks": SQL_CHECKS, "quality_case": SQL_QUALITY, "newest_first": SQL_NEWEST, "top_per_group": SQL_TOP,
}
