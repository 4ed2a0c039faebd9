"""Queries over text, names, cells, places, graphs and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import geo as G
from stemma.functions import text as X
from stemma.functions import unicode as U
from stemma.operators import audit as A
from stemma.operators import cited as C
from stemma.operators import graph as R
from stemma.operators import joins as J
from stemma.operators import ordered as O
from stemma.operators import resolve as V
from stemma.plans.tables import Tables


def regex_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DOI, bare DOI, year, URL state and URL key of each paper."""
    p = Tables(spark, sf_dir).papers
    return p.select(
        "paper_id",
        X.doi("doi").alias("doi_found"),
        X.year("publication_date", "title").alias("year_found"),
        X.is_full_url("publication_url").alias("is_url"),
        X.url_key("source_url").alias("url_key"),
        X.title_key_apart("venue").alias("venue_key"),
    )


SQL_REGEX = r"""
SELECT paper_id, nullif(regexp_replace(regexp_extract(lower(doi), '10\.[0-9]{4,9}/[^\s"<>]+', 0), '[.,;]+$', ''), '') AS doi_found,
  CAST(coalesce(nullif(regexp_extract(CAST(publication_date AS VARCHAR), '\b((?:19|20)[0-9]{2})\b', 1), ''), nullif(regexp_extract(title, '\b((?:19|20)[0-9]{2})\b', 1), '')) AS INTEGER) AS year_found,
  coalesce(regexp_matches(publication_url, '(?i)^\s*https?://[^/\s?#]+'), false) AS is_url,
  regexp_replace(regexp_replace(nullif(trim(source_url), ''), '#.*$', ''), '/+$', '') AS url_key,
  nullif(trim(regexp_replace(lower(venue), '[^a-z0-9]+', ' ', 'g')), '') AS venue_key FROM papers
"""


def json_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type with the sum of a number in their JSON properties."""
    e = Tables(spark, sf_dir).events
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return e.groupBy("event_type").agg(F.count(k).alias("n"), F.sum(k).alias("total"))


SQL_JSON = "SELECT event_type, count(json_extract_string(props, '$.k')) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY event_type"


def tags_stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords with mark-up made spaces."""
    p = Tables(spark, sf_dir).papers
    return p.where("keywords is not null").select("paper_id", X.without_tags("keywords").alias("plain"))


SQL_TAGS = r"SELECT paper_id, nullif(trim(regexp_replace(regexp_replace(keywords, '<[^>]*>', ' ', 'g'), '[\s\x{00a0}]+', ' ', 'g')), '') AS plain FROM papers WHERE keywords IS NOT NULL"


def citation_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of notes that cite a source, and how many different sources each note cites."""
    d = Tables(spark, sf_dir).documents.where("document_type = 'note'")
    lines = O.lines_of(d.select("doc_id", "text")).where(~F.col("line").rlike(r"^\s*(#|\||>)") & (F.trim("line") != ""))
    ids = X.citation_ids("line")
    cited = lines.select("doc_id", (F.size(ids) > 0).alias("has"), ids.alias("ids"))
    return cited.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("has").alias("n_cited"), F.size(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("n_sources"))


SQL_COVERAGE = r"""
WITH l AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line FROM documents WHERE document_type = 'note'),
k AS (SELECT doc_id, regexp_extract_all(line, '\[([0-9]+)\]', 1) AS ids FROM l WHERE NOT regexp_matches(line, '^\s*(#|\||>)') AND trim(line) <> '')
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE len(ids) > 0) AS n_cited, CAST(len(list_distinct(flatten(list(ids)))) AS INTEGER) AS n_sources FROM k GROUP BY doc_id
"""


def citation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes against lists of their sources that lack some, have others more, and give some a different URL."""
    t = Tables(spark, sf_dir)
    notes = t.documents.where("document_type = 'note'").select("doc_id", "text").distinct()
    cited = notes.select("doc_id", F.explode(X.citation_ids("text")).alias("source_id")).distinct().where((F.col("doc_id") + F.col("source_id")) % 3 != 0)
    more = notes.select("doc_id", F.explode(F.array(F.lit(1), F.lit(1000))).alias("source_id")).where((F.col("doc_id") + F.col("source_id")) % 5 == 0)
    url = F.concat(F.lit("https://s.example/"), F.col("source_id").cast("string"))
    listed = cited.union(more).distinct().withColumn("url", F.when(F.col("source_id") % 4 == 0, F.concat(url, F.lit("/x"))).otherwise(F.concat(url, F.lit("/#top"))))
    return C.citation_check(notes, listed, t.harvest_sources.select("source_id", url.alias("url")))


SQL_CITED = r"""
WITH c AS (SELECT DISTINCT doc_id, CAST(unnest(regexp_extract_all(text, '\[([0-9]+)\]', 1)) AS INTEGER) AS source_id FROM documents WHERE document_type = 'note'),
l AS (SELECT * FROM c WHERE (doc_id + source_id) % 3 <> 0 UNION SELECT doc_id, s FROM documents, (VALUES (1), (1000)) AS v(s) WHERE document_type = 'note' AND (doc_id + s) % 5 = 0),
j AS (SELECT coalesce(c.doc_id, l.doc_id) AS doc_id, coalesce(c.source_id, l.source_id) AS source_id, c.doc_id IS NOT NULL AS cited, l.doc_id IS NOT NULL AS listed FROM c FULL JOIN l ON c.doc_id = l.doc_id AND c.source_id = l.source_id),
i AS (SELECT doc_id, source_id, CASE WHEN source_id NOT IN (SELECT source_id FROM harvest_sources) THEN 'unknown' WHEN NOT listed THEN 'unlisted' WHEN NOT cited THEN 'uncited' WHEN source_id % 4 = 0 THEN 'url_mismatch' END AS issue FROM j)
SELECT * FROM i WHERE issue IS NOT NULL
"""


def document_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters of each numbered section of the full texts."""
    d = Tables(spark, sf_dir).documents.where("document_type = 'fulltext'")
    lines = O.lines_of(d.select("doc_id", "text"))
    s = O.section_of(lines, F.col("line").rlike(r"^[0-9]+ [A-Z]"))
    return s.groupBy("doc_id", "section").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


SQL_SECTIONS = r"""
WITH l AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line, generate_subscripts(regexp_split_to_array(text, '\r?\n'), 1) AS n FROM documents WHERE document_type = 'fulltext'),
s AS (SELECT *, last_value(CASE WHEN regexp_matches(line, '^[0-9]+ [A-Z]') THEN trim(line) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM l)
SELECT doc_id, section, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM s GROUP BY doc_id, section
"""


def last_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines behind the last section heading of each full text, up to the next blank line."""
    d = Tables(spark, sf_dir).documents.where("document_type = 'fulltext'")
    lines = O.lines_of(d.select("doc_id", "text"))
    return O.after_last_heading(lines, F.col("line").rlike(r"^[0-9]+ [A-Z]"), F.trim("line") == "").select("doc_id", "line_no", "line")


SQL_LAST = r"""
WITH l AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line, generate_subscripts(regexp_split_to_array(text, '\r?\n'), 1) AS line_no FROM documents WHERE document_type = 'fulltext'),
h AS (SELECT doc_id, max(line_no) AS h FROM l WHERE regexp_matches(line, '^[0-9]+ [A-Z]') GROUP BY doc_id),
e AS (SELECT l.doc_id, min(line_no) AS e FROM l JOIN h USING (doc_id) WHERE line_no > h AND trim(line) = '' GROUP BY l.doc_id)
SELECT l.doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM l JOIN h USING (doc_id) LEFT JOIN e USING (doc_id) WHERE line_no > h AND (e IS NULL OR line_no < e)
"""


def joined_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List items of notes, their lines joined."""
    d = Tables(spark, sf_dir).documents.where("document_type = 'note'")
    lines = O.lines_of(d.select("doc_id", "text").distinct()).where("trim(line) <> ''")
    return O.joined_items(lines, F.col("line").rlike(r"^(-|#)"))


SQL_ITEMS = r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE document_type = 'note'),
l AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line, generate_subscripts(regexp_split_to_array(text, '\r?\n'), 1) AS n FROM d),
i AS (SELECT doc_id, n, trim(line) AS line, sum(CASE WHEN regexp_matches(line, '^(-|#)') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS item FROM l WHERE trim(line) <> '')
SELECT doc_id, CAST(item AS BIGINT) AS item_no, replace(regexp_replace(string_agg(line, chr(1) ORDER BY n), '(\w)-\x01([a-z])', '\1\2', 'g'), chr(1), ' ') AS item FROM i GROUP BY doc_id, item
"""


def quoted_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a paper that hold the paper's title word for word."""
    t = Tables(spark, sf_dir)
    d = t.documents.where("paper_id is not null").select("doc_id", "paper_id", "text")
    j = d.join(t.papers.select("paper_id", "title"), "paper_id")
    return j.select("doc_id", "paper_id", X.quoted_in("title", "text").alias("held"))


def cell_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of cells in several text columns of papers."""
    p = Tables(spark, sf_dir).papers
    cells = p.select(F.explode(F.array(F.col("isbn"), F.col("pmid"), F.col("arxiv_id"), F.col("publication_year").cast("string"), F.col("publication_date").cast("string"))).alias("cell"))
    return cells.groupBy(X.coerced("cell").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


SQL_CELLS = r"""
WITH c AS (SELECT trim(unnest([isbn, pmid, arxiv_id, CAST(publication_year AS VARCHAR), CAST(publication_date AS VARCHAR)])) AS s FROM papers)
SELECT CASE WHEN s IS NULL OR s = '' THEN NULL WHEN lower(s) IN ('true', 'false') THEN 'bool' WHEN regexp_matches(s, '^[+-]?[0-9]{1,18}$') THEN 'int'
  WHEN regexp_matches(s, '^[+-]?([0-9]+\.[0-9]*|\.[0-9]+|[0-9]+)([eE][+-]?[0-9]+)?$') THEN 'float'
  WHEN regexp_matches(s, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AND try_cast(s AS DATE) IS NOT NULL THEN 'date'
  WHEN regexp_matches(s, '^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}') AND try_cast(s AS TIMESTAMP) IS NOT NULL THEN 'datetime' ELSE 'string' END AS kind, count(*) AS n FROM c GROUP BY 1
"""


def name_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rungs on which resolved author names agree with their professor's (exact rungs only, so that SQL can check them)."""
    t = Tables(spark, sf_dir)
    a = t.authorships.where("professor_id is not null").select("authorship_id", "professor_id", X.name_key_ascii("author_name_as_published").alias("author")).distinct()
    j = a.join(t.professors.select("professor_id", X.name_key_ascii("full_name").alias("person")), "professor_id")
    return j.groupBy(V.exact_rungs(F.col("author"), F.col("person")).alias("rung")).agg(F.count(F.lit(1)).alias("n"))


SQL_LADDER = """
WITH j AS (SELECT nullif(trim(regexp_replace(lower(a.author_name_as_published), '[^a-z0-9]+', ' ', 'g')), '') AS a, nullif(trim(regexp_replace(lower(p.full_name), '[^a-z0-9]+', ' ', 'g')), '') AS p
  FROM (SELECT DISTINCT authorship_id, professor_id, author_name_as_published FROM authorships WHERE professor_id IS NOT NULL) a JOIN professors p USING (professor_id)),
k AS (SELECT *, string_split(a, ' ') AS wa, string_split(p, ' ') AS wp FROM j)
SELECT CASE WHEN a = p THEN 'EXACT' WHEN wa[-1] = wp[-1] AND wa[1] = wp[1] THEN 'FIRST_LAST' WHEN wa[-1] = wp[-1] AND length(wa[1]) = 1 AND wa[1][1] = wp[1][1] THEN 'FIRST_INITIAL'
  WHEN wa[-1] = wp[-1] AND list_aggregate(list_transform(wa, lambda x: x[1]), 'string_agg', '') = list_aggregate(list_transform(wp, lambda x: x[1]), 'string_agg', '') THEN 'INITIALS' END AS rung, count(*) AS n FROM k GROUP BY 1
"""


def name_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One decision for each author occurrence: classification and confidence (with similarity in Python)."""
    t = Tables(spark, sf_dir)
    occ = t.authorships.select(F.col("authorship_id").alias("occurrence_id"), F.col("paper_id").alias("publication_id"), F.col("professor_id").alias("person_ref"), U.key("author_name_as_published").alias("name")).dropDuplicates(["occurrence_id"])
    roster = t.professors.select(F.col("professor_id").alias("person_id"), U.key("full_name").alias("name"))
    return V.resolved(occ, roster)


def graph_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display names of profiles against the names of professors: exists, review or create."""
    t = Tables(spark, sf_dir)
    return V.graph_ladder(t.author_profiles.select(F.col("display_name").alias("name")), t.professors.select(F.col("full_name").alias("name")), F.lower(F.trim("name")))


SQL_GRAPH_LADDER = """
SELECT DISTINCT display_name AS name, CASE WHEN display_name IN (SELECT full_name FROM professors) THEN 'exists'
  WHEN lower(trim(display_name)) IN (SELECT lower(trim(full_name)) FROM professors) THEN 'review' ELSE 'create' END AS action FROM author_profiles
"""


def similar_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of papers within two years of each other whose titles are similar to at least 0.85 (similarity in Python: no SQL)."""
    p = Tables(spark, sf_dir).papers.select("paper_id", X.title_key("title").alias("title_key"), "publication_year")
    return J.similar_titles(p, "paper_id", "title_key", "publication_year")


def unicode_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many different names remain under each normaliser."""
    a = Tables(spark, sf_dir).authorships.select("author_name_as_published").distinct()
    n = F.col("author_name_as_published")
    keys = {"raw": n, "compat_lower": U.compat_lower(n), "marks_apart": U.marks_apart(n), "key": U.key(n), "key_kept": U.key_kept(n), "case_folded": U.case_folded(n), "compat_folded": U.compat_folded(n)}
    one = a.select(*(c.alias(k) for k, c in keys.items()))
    return one.agg(*(F.count_distinct(k).alias(k) for k in keys))


def hash_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each user as a chained log, some of which were altered later: the last hash, and whether the chain verifies."""
    e = Tables(spark, sf_dir).events
    log = A.chained(e.select("user_id", "event_id", "event_type"), ["user_id"], "event_id", F.concat_ws("|", F.col("event_id").cast("string"), F.col("event_type")))
    log = log.withColumn("payload", F.when(F.col("event_id") % 97 == 0, "altered").otherwise(F.col("payload")))
    ok = A.verified(log, ["user_id"], "event_id")
    return ok.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.max_by("event_hash", "event_id").alias("last_hash"), F.bool_and(F.col("link_ok") & F.col("hash_ok")).alias("ok"))


SQL_CHAIN = """
WITH RECURSIVE e AS (SELECT user_id, event_id, event_id || '|' || event_type AS p, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events),
c AS (SELECT user_id, k, n, sha256(repeat('0', 64) || '|' || p) AS h FROM e WHERE k = 1
  UNION ALL SELECT e.user_id, e.k, e.n, sha256(c.h || '|' || e.p) FROM c JOIN e ON e.user_id = c.user_id AND e.k = c.k + 1)
SELECT user_id, n AS n_events, h AS last_hash, NOT EXISTS (SELECT 1 FROM events v WHERE v.user_id = c.user_id AND v.event_id % 97 = 0) AS ok FROM c WHERE k = n
"""


def pointer_chase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document points to the one before it with the same text; all lead to the first."""
    d = Tables(spark, sf_dir).documents.where("text is not null").select("doc_id", "text")
    from pyspark.sql import Window

    edges = d.select("doc_id", F.lag("doc_id").over(Window.partitionBy(F.sha2("text", 256)).orderBy("doc_id")).alias("original_id"))
    return R.chase(edges, "doc_id", "original_id")


SQL_CHASE = """
SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS root, CASE WHEN doc_id = min(doc_id) OVER (PARTITION BY text) THEN 'root' ELSE 'found' END AS status FROM documents WHERE text IS NOT NULL
"""


def pointer_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that reach the first one with their text within five hops."""
    from pyspark.sql import Window

    d = Tables(spark, sf_dir).documents.where("text is not null").select("doc_id", "text")
    edges = d.select("doc_id", F.lag("doc_id").over(Window.partitionBy(F.sha2("text", 256)).orderBy("doc_id")).alias("original_id"))
    return R.chase_bounded(edges, "doc_id", "original_id", 5)


SQL_BOUNDED = "SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) <= 6 AS reached FROM documents WHERE text IS NOT NULL"


def topic_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics in pre-order with depth and path."""
    return R.tree(Tables(spark, sf_dir).topics, "topic_id", "parent_topic_id", "topic_name")


SQL_TREE = """
WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY parent_topic_id ORDER BY topic_name, topic_id) AS k FROM topics),
r AS (SELECT topic_id, 0 AS depth, topic_name AS path, lpad(CAST(k AS VARCHAR), 10, '0') AS key FROM s WHERE parent_topic_id IS NULL
  UNION ALL SELECT s.topic_id, r.depth + 1, r.path || ' / ' || s.topic_name, r.key || '.' || lpad(CAST(s.k AS VARCHAR), 10, '0') FROM s JOIN r ON s.parent_topic_id = r.topic_id)
SELECT topic_id, depth, path, row_number() OVER (ORDER BY key) AS place FROM r
"""


def collision_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Department names, told apart by their id where several departments share one."""
    return R.unique_names(Tables(spark, sf_dir).departments.select("department_id", "department_name"), "department_name", "department_id").select("department_id", "unique_name")


SQL_NAMES = "SELECT department_id, CASE WHEN count(*) OVER (PARTITION BY department_name) > 1 THEN department_name || '_' || department_id ELSE department_name END AS unique_name FROM departments"


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    lat = (F.col("key") * 7919 % 18000) / 100.0 - 90
    lon = (F.col("key") * 104729 % 36000) / 100.0 - 180
    p = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key")).unionByName(t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key")))
    return p.withColumn("lat", lat).withColumn("lon", lon)


_SQL_PLACES = "SELECT kind, key, (key * 7919 % 18000) / 100.0 - 90 AS lat, (key * 104729 % 36000) / 100.0 - 180 AS lon FROM (SELECT 'customer' AS kind, c_custkey AS key FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier)"


def nearest_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty places nearest to a point."""
    p = _places(spark, sf_dir).withColumn("metres", F.round(G.haversine(F.col("lat"), F.col("lon"), F.lit(48.2), F.lit(16.4)), 0))
    return O.top_by(p, [F.asc_nulls_last("metres"), F.col("kind"), F.col("key")], 20).select("kind", "key", "metres")


SQL_NEAREST = f"""
SELECT kind, key, round(2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(48.2 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(48.2)) * pow(sin(radians(16.4 - lon) / 2), 2)))), 0) AS metres
FROM ({_SQL_PLACES}) ORDER BY metres, kind, key LIMIT 20
"""


def in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places in a box whose corners come in any order."""
    p = _places(spark, sf_dir)
    return p.where(G.in_box(F.col("lat"), F.col("lon"), (50.0, 20.0), (10.0, -15.0))).select("kind", "key")


SQL_BOX = f"SELECT kind, key FROM ({_SQL_PLACES}) WHERE lat BETWEEN 10 AND 50 AND lon BETWEEN -15 AND 20"


def within_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places within 2,000 km of a point."""
    p = _places(spark, sf_dir)
    return p.where(G.within(F.col("lat"), F.col("lon"), (48.2, 16.4), 2_000_000.0)).select("kind", "key")


SQL_RADIUS = f"SELECT kind, key FROM ({_SQL_PLACES}) WHERE 2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(48.2 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(48.2)) * pow(sin(radians(16.4 - lon) / 2), 2)))) <= 2000000"


def registered_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source URLs of papers, each once, numbered by first appearance."""
    return C.registered(Tables(spark, sf_dir).papers.select(F.col("source_url").alias("url"), "paper_id"), "paper_id")


SQL_REGISTERED = r"""
WITH u AS (SELECT regexp_replace(regexp_replace(nullif(trim(source_url), ''), '#.*$', ''), '/+$', '') AS url, paper_id FROM papers),
f AS (SELECT url, min(paper_id) AS o FROM u WHERE url IS NOT NULL GROUP BY url)
SELECT row_number() OVER (ORDER BY o, url) AS source_id, url FROM f
"""


def rendered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rendered for each paper, skipping empty fields, with its hash."""
    p = Tables(spark, sf_dir).papers
    line = lambda label, c: F.concat(F.lit(f"{label}: "), c)
    text = F.concat_ws("\n", line("Paper", F.col("paper_id").cast("string")), line("Year", F.col("publication_year").cast("string")), line("Venue", F.nullif(F.trim("venue"), F.lit(""))))
    return p.select("paper_id", text.alias("text"), F.sha2(text, 256).alias("sha256"))


SQL_RENDERED = """
WITH r AS (SELECT paper_id, concat_ws(chr(10), 'Paper: ' || paper_id, 'Year: ' || publication_year, 'Venue: ' || nullif(trim(venue), '')) AS text FROM papers) SELECT *, sha256(text) AS sha256 FROM r
"""


def status_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers by the rank of their status, free of case."""
    order = ("discovered", "metadata_found", "abstract_found", "full_text_found")
    return Tables(spark, sf_dir).papers.groupBy(X.rank_of("metadata_status", order).alias("rank")).agg(F.count(F.lit(1)).alias("n"))


SQL_RANKS = "SELECT CASE lower(trim(metadata_status)) WHEN 'discovered' THEN 1 WHEN 'metadata_found' THEN 2 WHEN 'abstract_found' THEN 3 WHEN 'full_text_found' THEN 4 ELSE 0 END AS rank, count(*) AS n FROM papers GROUP BY 1"


def formatted_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-filled ids and file names of papers."""
    p = Tables(spark, sf_dir).papers
    return p.select("paper_id", X.zero_filled(F.col("paper_id").cast("string")).alias("filled"), X.file_name("publication_year", "venue").alias("file"))


SQL_FORMATTED = r"""
SELECT paper_id, lpad(CAST(paper_id AS VARCHAR), CAST(greatest(8, length(CAST(paper_id AS VARCHAR))) AS INTEGER), '0') AS filled,
  left(concat_ws('_', CAST(publication_year AS VARCHAR), nullif(regexp_replace(regexp_replace(venue, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '')), 120) || '.pdf' AS file FROM papers
"""

_ALL = (
    regex_fields, json_properties, tags_stripped, citation_coverage, citation_check, document_sections, last_section, joined_items, quoted_passages, cell_kinds, name_ladder, name_decisions, graph_ladder,
    similar_titles, unicode_keys, hash_chain, pointer_chase, pointer_bounded, topic_tree, collision_names, nearest_k, in_box, within_radius, registered_sources, rendered_records, status_ranks, formatted_fields,
)
QUERIES = {f.__name__: f for f in _ALL}
SQL = {
    "regex_fields": SQL_REGEX, "json_properties": SQL_JSON, "tags_stripped": SQL_TAGS, "citation_coverage": SQL_COVERAGE, "citation_check": SQL_CITED, "document_sections": SQL_SECTIONS, "last_section": SQL_LAST,
    "joined_items": SQL_ITEMS, "cell_kinds": SQL_CELLS, "name_ladder": SQL_LADDER, "graph_ladder": SQL_GRAPH_LADDER, "hash_chain": SQL_CHAIN, "pointer_chase": SQL_CHASE, "pointer_bounded": SQL_BOUNDED,
    "topic_tree": SQL_TREE, "collision_names": SQL_NAMES, "nearest_k": SQL_NEAREST, "in_box": SQL_BOX, "within_radius": SQL_RADIUS, "registered_sources": SQL_REGISTERED, "rendered_records": SQL_RENDERED,
    "status_ranks": SQL_RANKS, "formatted_fields": SQL_FORMATTED,
}
