"""Queries over projections, memberships, orders and ranges of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import text as X
from stemma.functions import unicode as U
from stemma.operators import filters as P
from stemma.operators import graph as G
from stemma.operators import ordered as O
from stemma.operators import records as R
from stemma.operators import resolve as V
from stemma.plans.tables import Tables

_CLEAN = r"nullif(regexp_replace({c}, '^[\s\x{{00a0}}\x{{3000}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{1680}}\x{{0085}}]+|[\s\x{{00a0}}\x{{3000}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{1680}}\x{{0085}}]+$', '', 'g'), '')"


def _clean(c: str) -> str:
    return _CLEAN.format(c=c)


_PUBLICATION = {
    "name": "title", "abstract_text": "abstract", "venue_name": "venue", "publisher_name": "publisher", "isbn_issn": "isbn", "preprint": "arxiv_id", "pubmed": "pmid", "url": "publication_url", "pdf_url": "legitimate_pdf_url",
    "keyword_text": "keywords", "topic_text": "research_topics", "source": "source_name", "landing_url": "source_url", "status": "metadata_status", "text_status": "full_text_status",
}


def publication_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers under the names of a publication record, 17 columns, untitled ones dropped."""
    columns = dict(_PUBLICATION) | {"year": F.col("publication_year")}
    return R.projected(Tables(spark, sf_dir).papers, columns, ["name"], ["paper_id"])


SQL_PUBLICATIONS = "SELECT paper_id, " + ", ".join(f"{_clean(old)} AS {new}" for new, old in _PUBLICATION.items()) + f", publication_year AS year FROM papers WHERE {_clean('title')} IS NOT NULL"


def profile_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Professors as profiles: cleaned parts, the name put together, contact parts joined by a hyphen."""
    p = Tables(spark, sf_dir).professors
    columns = {
        "prefix": "academic_title", "first_name": "first_name", "middle_name": "middle_name", "last_name": "last_name", "mail": "email", "bio": "research_interests",
        "full": P.assembled("first_name", "middle_name", "last_name"), "contact": R.joined_parts("-", "office_location", "lab_name", "lab_url"),
    }
    return R.projected(p, columns, keep=["professor_id"])


SQL_PROFILES = f"""SELECT professor_id, {_clean('academic_title')} AS prefix, {_clean('first_name')} AS first_name, {_clean('middle_name')} AS middle_name, {_clean('last_name')} AS last_name, {_clean('email')} AS mail, {_clean('research_interests')} AS bio,
  nullif(concat_ws(' ', {_clean('first_name')}, {_clean('middle_name')}, {_clean('last_name')}), '') AS "full", concat_ws('-', {_clean('office_location')}, {_clean('lab_name')}, {_clean('lab_url')}) AS contact FROM professors"""


def department_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each institution's list of departments, projected element by element, one row an element."""
    d = Tables(spark, sf_dir).departments
    item = F.when(F.col("department_id") % 5 != 0, F.struct("department_name", "department_url"))  # some elements are null
    lists = d.groupBy("institution").agg(F.array_sort(F.collect_list(F.struct("department_id", item.alias("x")))).alias("l"))
    entries = R.struct_list(F.transform("l", lambda e: e["x"]), {"unit": "department_name", "url": "department_url"})
    return lists.select("institution", F.posexplode(entries).alias("place", "e")).select("institution", (F.col("place") + 1).cast("bigint").alias("place"), "e.unit", "e.url")


SQL_ENTRIES = f"SELECT institution, row_number() OVER (PARTITION BY institution ORDER BY department_id) AS place, {_clean('department_name')} AS unit, {_clean('department_url')} AS url FROM departments WHERE department_id % 5 <> 0"


def author_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author lists of papers: position among all elements, name or else reference, and whether the reference is on the roster."""
    t = Tables(spark, sf_dir)
    a = t.authorships.select("authorship_id", "paper_id", "professor_id", "author_position").distinct()
    p = t.professors.groupBy("professor_id").agg(F.min("first_name").alias("first"), F.min("middle_name").alias("middle"), F.min("last_name").alias("last"))
    ref = F.coalesce(F.col("professor_id").cast("string"), F.concat(F.lit("x"), F.col("authorship_id").cast("string")))
    item = F.when(F.col("author_position").isNotNull(), F.struct("first", "middle", "last", ref.alias("ref")))
    lists = a.join(p, "professor_id", "left").groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("authorship_id", item.alias("x")))).alias("l"))
    rows = lists.select("paper_id", F.explode(R.author_list(F.transform("l", lambda e: e["x"]))).alias("e")).select("paper_id", F.col("e.position").cast("bigint").alias("position"), "e.name", "e.ref")
    return R.flagged(rows, "ref", t.professors.where("professor_id % 2 = 0").select(F.col("professor_id").cast("string")), "is_current")


SQL_AUTHORS = f"""
WITH p AS (SELECT professor_id, min(first_name) AS f, min(middle_name) AS m, min(last_name) AS l FROM professors GROUP BY 1),
a AS (SELECT DISTINCT authorship_id, paper_id, professor_id, author_position FROM authorships),
n AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY authorship_id) AS position FROM a),
r AS (SELECT paper_id, position, coalesce(CAST(n.professor_id AS VARCHAR), 'x' || authorship_id) AS ref, nullif(concat_ws(' ', {_clean('f')}, {_clean('m')}, {_clean('l')}), '') AS name, n.professor_id AS pid FROM n LEFT JOIN p USING (professor_id) WHERE author_position IS NOT NULL)
SELECT paper_id, position, coalesce(name, ref) AS name, ref, coalesce(pid % 2 = 0 AND pid IN (SELECT professor_id FROM professors), false) AS is_current FROM r
"""


def venue_row_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers of each folded venue and year that several papers share, undated ones together."""
    p = Tables(spark, sf_dir).papers.select(F.lower(F.trim("venue")).alias("place"), "publication_year", "paper_id")
    return R.row_indices(p, ["place", "publication_year"], "paper_id")


SQL_INDICES = "SELECT * FROM (SELECT lower(trim(venue)) AS place, publication_year, paper_id, count(*) OVER (PARTITION BY lower(trim(venue)), publication_year) AS n FROM papers) WHERE n > 1"


def link_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a person on a paper with its place, the first one marked."""
    a = Tables(spark, sf_dir).authorships.where("professor_id is not null").distinct()
    return R.occurrences(a, ["professor_id", "paper_id"], "authorship_id", ["author_position"])


SQL_OCCURRENCES = "SELECT *, occurrence = 1 AS is_first FROM (SELECT professor_id, paper_id, authorship_id, author_position, CAST(row_number() OVER (PARTITION BY professor_id, paper_id ORDER BY authorship_id) AS INTEGER) AS occurrence FROM (SELECT DISTINCT * FROM authorships) WHERE professor_id IS NOT NULL)"


def left_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least indentation of the non-blank lines of each document."""
    lines = O.lines_of(Tables(spark, sf_dir).documents.select("doc_id", "text")).where(F.col("line").rlike(r"^ *[^ \t\r\x0b\x0c]"))
    return R.group_least(lines, ["doc_id"], F.length(F.regexp_extract("line", "^( *)", 1)), "left_edge")


SQL_EDGES = r"""
WITH l AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line FROM documents)
SELECT doc_id, CAST(min(length(regexp_extract(line, '^( *)', 1))) AS INTEGER) AS left_edge FROM l WHERE regexp_matches(line, '^ *[^ \t\r\x0b\x0c]') GROUP BY doc_id
"""


def names_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Professors by name, whatever its case."""
    return R.by_name(Tables(spark, sf_dir).professors.select("professor_id", "full_name"), "full_name", "professor_id")


SQL_BY_NAME = "SELECT professor_id, full_name, row_number() OVER (ORDER BY lower(full_name) NULLS FIRST, professor_id) AS place FROM professors"


def lines_in_reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as boxes on pages: page by supplier, column by ship mode's line, top by order, left by line."""
    b = Tables(spark, sf_dir).lineitem.select(F.col("l_suppkey").alias("page"), F.col("l_linenumber").alias("col"), F.col("l_orderkey").alias("top"), F.col("l_partkey").alias("edge"))
    return R.reading_order(b, "page", "col", "top", "edge")


SQL_READING = "SELECT l_suppkey AS page, l_linenumber AS col, l_orderkey AS top, l_partkey AS edge, row_number() OVER (ORDER BY l_suppkey, l_linenumber, l_orderkey, l_partkey) AS place FROM lineitem"


def all_institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each spelling of an institution that any table has, once."""
    t = Tables(spark, sf_dir)
    return R.all_values((t.departments, "institution"), (t.professors, "institution"), (t.authorships, "institution"), (t.author_profiles, "affiliation"), name="institution")


SQL_ALL = "SELECT institution FROM departments WHERE institution IS NOT NULL UNION SELECT institution FROM professors WHERE institution IS NOT NULL UNION SELECT institution FROM authorships WHERE institution IS NOT NULL UNION SELECT affiliation FROM author_profiles WHERE affiliation IS NOT NULL"


def runs_of_a_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that started within seven days of a given time."""
    r = Tables(spark, sf_dir).ingestion_runs
    return r.where(R.in_range(F.col("started_at"), F.lit("2024-03-01 00:00:00").cast("timestamp"))).select("ingestion_id", "document_id", "status")


SQL_WEEK = "SELECT ingestion_id, document_id, status FROM ingestion_runs WHERE started_at BETWEEN TIMESTAMP '2024-03-01 00:00:00' AND TIMESTAMP '2024-03-08 00:00:00'"


def orphaned_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unfinished runs whose document has no text, or is none."""
    t = Tables(spark, sf_dir)
    owners = t.documents.where("text <> ''").select("doc_id")
    return R.orphaned(t.ingestion_runs, F.lower(F.trim("status")), ["processed", "failed", "completed", "done"], "document_id", owners).select("ingestion_id", "document_id", "status")


SQL_ORPHANS = "SELECT ingestion_id, document_id, status FROM ingestion_runs WHERE coalesce(lower(trim(status)), '') NOT IN ('processed', 'failed', 'completed', 'done') AND NOT EXISTS (SELECT 1 FROM documents WHERE doc_id = document_id AND text <> '')"


def topics_of_a_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics with a description, as far as their parents are walked: others are passed by with all below them."""
    t = Tables(spark, sf_dir).topics
    return G.walked(t, "topic_id", "parent_topic_id", "topic_name", F.col("topic_id") % 7 != 3).select("topic_id", "depth", "path")


SQL_KIND = """
WITH RECURSIVE r AS (SELECT topic_id, 0 AS depth, topic_name AS path FROM topics WHERE parent_topic_id IS NULL AND topic_id % 7 <> 3
  UNION ALL SELECT t.topic_id, r.depth + 1, r.path || ' / ' || t.topic_name FROM topics t JOIN r ON t.parent_topic_id = r.topic_id WHERE t.topic_id % 7 <> 3)
SELECT * FROM r
"""


def harvested_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs anywhere in the JSON of each paper, each once, in document order."""
    p = Tables(spark, sf_dir).papers
    none = F.lit(None).cast("string")
    entry = lambda u, t: F.struct(F.col(u).alias("url"), t.alias("title"))
    body = F.to_json(F.struct(F.array(entry("publication_url", F.col("title")), entry("source_url", none)).alias("items"), F.struct(entry("legitimate_pdf_url", none).alias("pdf"), entry("publication_url", none).alias("again")).alias("more")))
    return R.harvested(p.select("paper_id", body.alias("body")), "paper_id", "body")


SQL_HARVESTED = r"""
WITH u AS (SELECT paper_id, 1 AS n, publication_url AS url, title FROM papers UNION ALL SELECT paper_id, 2, source_url, NULL FROM papers UNION ALL SELECT paper_id, 3, legitimate_pdf_url, NULL FROM papers UNION ALL SELECT paper_id, 4, publication_url, NULL FROM papers),
k AS (SELECT paper_id, n, regexp_replace(regexp_replace(nullif(trim(url), ''), '#.*$', ''), '/+$', '') AS url, title FROM u WHERE trim(url) <> ''),
f AS (SELECT paper_id, url, min(n) AS n, arg_min(title, n) FILTER (WHERE title IS NOT NULL) AS t FROM k GROUP BY ALL)
SELECT paper_id, CAST(row_number() OVER (PARTITION BY paper_id ORDER BY n) AS INTEGER) AS place, url, CASE WHEN n = 1 THEN t END AS title FROM f
"""


def author_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification of every author occurrence, its confidence and its evidence (similarity in Python: no SQL)."""
    t = Tables(spark, sf_dir)
    occ = t.authorships.select(F.col("authorship_id").alias("occurrence_id"), F.col("paper_id").alias("publication_id"), F.col("professor_id").alias("person_ref"), U.key("author_name_as_published").alias("name"))
    return V.decisions(occ, t.professors.select(F.col("professor_id").alias("person_id"), U.key("full_name").alias("name")))


def topic_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic that stands behind the parent of some topics, in a positive or a negative role, when every third is passed through."""
    t = Tables(spark, sf_dir).topics
    kind = F.when(F.col("topic_id") % 3 == 0, "pass").when(F.col("topic_id") % 10 == 1, "other").otherwise("text")
    users = t.where("topic_id % 4 = 0 and parent_topic_id is not null").select(F.col("topic_id").alias("user"), F.when(F.col("topic_id") % 8 == 0, "positive").otherwise("negative").alias("role"), F.col("parent_topic_id").alias("at"))
    return G.upstream_roles(users, t.select(F.col("topic_id").alias("node"), kind.alias("kind"), F.col("parent_topic_id").alias("source")), F.col("kind") == "pass", F.col("kind") == "text")


SQL_ROLES = """
WITH RECURSIVE r AS (SELECT topic_id AS "user", CASE WHEN topic_id % 8 = 0 THEN 'positive' ELSE 'negative' END AS role, parent_topic_id AS target FROM topics WHERE topic_id % 4 = 0 AND parent_topic_id IS NOT NULL
  UNION ALL SELECT r."user", r.role, t.parent_topic_id FROM r JOIN topics t ON t.topic_id = r.target WHERE r.target % 3 = 0 AND t.parent_topic_id IS NOT NULL)
SELECT "user", role, target FROM r JOIN topics t ON t.topic_id = target WHERE target % 3 <> 0 AND target % 10 <> 1
"""


def wiki_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics as linked pages: links, index, tags, age, length and recorded hashes."""
    t = Tables(spark, sf_dir).topics
    name = lambda c: F.concat(F.lit("t"), F.col(c).cast("string"))
    text = F.concat(F.lit("see [["), F.coalesce(name("parent_topic_id"), F.lit("nowhere")), F.lit("]]"), F.lit("\n#k"), (F.col("topic_id") % 5).cast("string"), F.repeat(F.lit("\n"), (F.col("topic_id") % 9).cast("int")))
    pages = t.select(name("topic_id").alias("page"), text.alias("text"), F.to_date("created_at").alias("updated"), "topic_id")
    index = pages.where("topic_id % 9 <> 2").select("page").unionByName(spark.createDataFrame([("t9999",)], "page string"))
    hashes = pages.select("page", F.when(F.col("topic_id") % 10 == 4, "0").otherwise(F.sha2("text", 256)).alias("sha256"))
    return G.wiki_report(pages.drop("topic_id"), "2020-01-01", 7, index, ["k0", "k1", "k2", "k3"], hashes)


SQL_WIKI = """
WITH p AS (SELECT topic_id, 't' || topic_id AS page, coalesce('t' || parent_topic_id, 'nowhere') AS l, CAST(created_at AS DATE) AS updated, 'see [[' || coalesce('t' || parent_topic_id, 'nowhere') || ']]' || chr(10) || '#k' || topic_id % 5 || repeat(chr(10), topic_id % 9) AS text FROM topics)
SELECT page, 'broken_link' AS issue, l AS detail FROM p WHERE l NOT IN (SELECT page FROM p)
UNION ALL SELECT page, 'orphan', NULL FROM p WHERE page NOT IN (SELECT l FROM p a WHERE a.page <> a.l)
UNION ALL SELECT page, 'stale', CAST(updated AS VARCHAR) FROM p WHERE updated < DATE '2020-01-01'
UNION ALL SELECT page, 'long', CAST(2 + topic_id % 9 AS VARCHAR) FROM p WHERE 2 + topic_id % 9 > 7
UNION ALL SELECT page, 'not_indexed', NULL FROM p WHERE topic_id % 9 = 2
UNION ALL SELECT 't9999', 'indexed_only', NULL
UNION ALL SELECT page, 'unknown_tag', 'k4' FROM p WHERE topic_id % 5 = 4
UNION ALL SELECT page, 'changed', sha256(text) FROM p WHERE topic_id % 10 = 4
"""


_ALL = (
    publication_records, profile_records, department_entries, author_entries, venue_row_indices, link_occurrences, left_edges, names_in_order, lines_in_reading_order, all_institutions, runs_of_a_week, orphaned_runs,
    topics_of_a_kind, harvested_links, author_decisions, topic_roles, wiki_issues,
)
QUERIES = {f.__name__: f for f in _ALL}
SQL = dict(
    publication_records=SQL_PUBLICATIONS, profile_records=SQL_PROFILES, department_entries=SQL_ENTRIES, author_entries=SQL_AUTHORS, venue_row_indices=SQL_INDICES, link_occurrences=SQL_OCCURRENCES, left_edges=SQL_EDGES,
    names_in_order=SQL_BY_NAME, lines_in_reading_order=SQL_READING, all_institutions=SQL_ALL, runs_of_a_week=SQL_WEEK, orphaned_runs=SQL_ORPHANS, topics_of_a_kind=SQL_KIND, harvested_links=SQL_HARVESTED, topic_roles=SQL_ROLES, wiki_issues=SQL_WIKI,
)
