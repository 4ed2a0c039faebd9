"""Queries over joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import text as X
from stemma.operators import joins as J
from stemma.operators import ordered as O
from stemma.operators import quality as Q
from stemma.plans.tables import Tables

def _plain_key(c: str):
    return F.nullif(F.trim(F.regexp_replace(F.lower(F.col(c)), r"[^a-z0-9]+", " ")), F.lit(""))


_KEY = "nullif(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), '')"


def ordered_children_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers with a text and an author of a department of computer science, with all their authors in order."""
    t = Tables(spark, sf_dir)
    papers = t.papers.where("trim(abstract) <> ''").select("paper_id", "publication_year")
    links = t.authorships.select("authorship_id", "paper_id", "professor_id", "author_position", "author_name_as_published").distinct()
    chosen = t.departments.where("department_name = 'Computer Science'").select("department_id")
    people = t.professors.select("professor_id", "department_id")
    inside = links.join(people, "professor_id").join(chosen, "department_id", "left_semi").select("paper_id")
    kept = papers.join(inside, "paper_id", "left_semi")
    names = O.ordered_list(F.col("author_name_as_published"), [F.col("author_position"), F.col("authorship_id")])
    children = links.groupBy("paper_id").agg(names.alias("names"))
    return kept.join(children, "paper_id").select("paper_id", "publication_year", F.array_join("names", "; ").alias("authors"))


SQL_ORDERED_CHILDREN = """
WITH links AS (SELECT DISTINCT authorship_id, paper_id, professor_id, author_position, author_name_as_published FROM authorships)
SELECT p.paper_id, p.publication_year, string_agg(l.author_name_as_published, '; ' ORDER BY l.author_position NULLS LAST, l.authorship_id) AS authors
FROM papers p JOIN links l ON l.paper_id = p.paper_id
WHERE trim(p.abstract) <> '' AND EXISTS (
  SELECT 1 FROM links a JOIN professors f ON f.professor_id = a.professor_id JOIN departments d ON d.department_id = f.department_id
  WHERE a.paper_id = p.paper_id AND d.department_name = 'Computer Science')
GROUP BY p.paper_id, p.publication_year
"""


def left_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paper with its resolved professors (left joins): number and smallest id."""
    t = Tables(spark, sf_dir)
    a = t.authorships.select("authorship_id", "paper_id", "professor_id").distinct()
    j = t.papers.select("paper_id").join(a, "paper_id", "left").join(t.professors.select("professor_id", "department_id"), "professor_id", "left")
    return j.groupBy("paper_id").agg(F.count("authorship_id").alias("n_authorships"), F.count("department_id").alias("n_in_departments"), F.min("professor_id").alias("first_professor"))


SQL_LEFT_CHAIN = """
SELECT p.paper_id, count(a.authorship_id) AS n_authorships, count(f.department_id) AS n_in_departments, min(a.professor_id) AS first_professor
FROM papers p LEFT JOIN (SELECT DISTINCT authorship_id, paper_id, professor_id FROM authorships) a ON a.paper_id = p.paper_id
LEFT JOIN professors f ON f.professor_id = a.professor_id GROUP BY p.paper_id
"""


def lookup_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author profiles resolved by ORCID cell, then by name, then by last-winning scholar reference."""
    t = Tables(spark, sf_dir)
    p = t.professors.withColumn("name_key", _plain_key("full_name"))
    by_orcid = J.last_wins(p.where("orcid <> ''"), "orcid", F.col("professor_id"))
    by_name = J.last_wins(p, "name_key", F.col("professor_id"))
    by_ref = J.last_wins(p, "semantic_scholar_id", F.col("professor_id"))
    rows = t.author_profiles.select("profile_id", "orcid", "scholar_ref", _plain_key("display_name").alias("name_key"))
    found = J.lookup_fallback(rows, [("orcid", by_orcid, "orcid", "professor_id"), ("name_key", by_name, "name_key", "professor_id"), ("scholar_ref", by_ref, "semantic_scholar_id", "professor_id")])
    return found.select("profile_id", "found_id", "found_by")


SQL_LOOKUP = f"""
WITH o AS (SELECT orcid, max(professor_id) AS id FROM professors WHERE orcid <> '' GROUP BY orcid),
n AS (SELECT {_KEY.format(c="full_name")} AS k, max(professor_id) AS id FROM professors GROUP BY 1),
r AS (SELECT semantic_scholar_id AS k, max(professor_id) AS id FROM professors WHERE semantic_scholar_id IS NOT NULL GROUP BY 1)
SELECT a.profile_id, coalesce(o.id, n.id, r.id) AS found_id,
  CASE WHEN o.id IS NOT NULL THEN 'orcid' WHEN n.id IS NOT NULL THEN 'name_key' WHEN r.id IS NOT NULL THEN 'scholar_ref' END AS found_by
FROM author_profiles a LEFT JOIN o ON o.orcid = a.orcid LEFT JOIN n ON n.k = {_KEY.format(c="a.display_name")} LEFT JOIN r ON r.k = a.scholar_ref
"""


def unique_candidate_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unresolved authorships whose first and last name part fit exactly one professor."""
    t = Tables(spark, sf_dir)

    def keyed(df: DataFrame, c: str) -> DataFrame:
        parts = X.name_parts(_plain_key(c))
        return df.withColumn("first", parts["first"]).withColumn("last", parts["last"])

    rows = keyed(t.authorships.where("professor_id is null").select("authorship_id", "author_name_as_published").distinct(), "author_name_as_published")
    return J.unique_candidate(rows, "authorship_id", keyed(t.professors, "full_name"), ["first", "last"], "professor_id")


SQL_UNIQUE = f"""
WITH p AS (SELECT professor_id, string_split({_KEY.format(c="full_name")}, ' ') AS w FROM professors),
a AS (SELECT DISTINCT authorship_id, string_split({_KEY.format(c="author_name_as_published")}, ' ') AS w FROM authorships WHERE professor_id IS NULL)
SELECT a.authorship_id, min(p.professor_id) AS professor_id FROM a JOIN p ON a.w[1] = p.w[1] AND a.w[-1] = p.w[-1]
GROUP BY a.authorship_id HAVING min(p.professor_id) = max(p.professor_id)
"""


def self_match_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authorships of papers on which another row has the same name."""
    t = Tables(spark, sf_dir)
    rows = t.authorships.select("authorship_id", "paper_id", _plain_key("author_name_as_published").alias("name_key")).distinct()
    return J.other_in_group(rows, "paper_id", "authorship_id", "name_key").select("authorship_id", "paper_id")


SQL_SELF = f"""
WITH r AS (SELECT DISTINCT authorship_id, paper_id, {_KEY.format(c="author_name_as_published")} AS k FROM authorships)
SELECT a.authorship_id, a.paper_id FROM r a
WHERE EXISTS (SELECT 1 FROM r b WHERE b.paper_id = a.paper_id AND b.k = a.k AND b.authorship_id <> a.authorship_id)
"""


def occurrence_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The k-th resolved row with the k-th row of each paper and position; leftovers on either side are kept."""
    t = Tables(spark, sf_dir)
    a = t.authorships.select("authorship_id", "paper_id", "author_position", "professor_id").distinct()
    left = a.where("professor_id is not null").select("paper_id", "author_position", F.col("authorship_id").alias("decision_id"))
    right = a.select("paper_id", "author_position", F.col("authorship_id").alias("occurrence_id"))
    out = O.kth_pairs(left, right, ["paper_id", "author_position"], ["decision_id"], ["occurrence_id"])
    return out.select("paper_id", "author_position", F.col("k").cast("bigint").alias("k"), "l.decision_id", "r.occurrence_id")


SQL_PAIRING = """
WITH a AS (SELECT DISTINCT authorship_id, paper_id, author_position, professor_id FROM authorships),
l AS (SELECT paper_id, author_position, authorship_id AS decision_id, row_number() OVER (PARTITION BY paper_id, author_position ORDER BY authorship_id) AS k FROM a WHERE professor_id IS NOT NULL),
r AS (SELECT paper_id, author_position, authorship_id AS occurrence_id, row_number() OVER (PARTITION BY paper_id, author_position ORDER BY authorship_id) AS k FROM a)
SELECT coalesce(l.paper_id, r.paper_id) AS paper_id, coalesce(l.author_position, r.author_position) AS author_position, coalesce(l.k, r.k) AS k, decision_id, occurrence_id
FROM l FULL JOIN r ON l.paper_id = r.paper_id AND l.author_position IS NOT DISTINCT FROM r.author_position AND l.k = r.k
"""


def queue_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author profiles take professors of their institution tier by tier: same name, then any; each professor once."""
    t = Tables(spark, sf_dir)
    d = t.author_profiles.where("affiliation is not null").select("profile_id", F.col("affiliation").alias("place"), _plain_key("display_name").alias("name_key"))
    o = t.professors.where("institution is not null").select("professor_id", F.col("institution").alias("place"), _plain_key("full_name").alias("name_key"))
    return J.queue_tiers(d.fillna("", ["name_key"]), o.fillna("", ["name_key"]), "place", "profile_id", "professor_id", [["name_key"], []])


SQL_TIERS = f"""
WITH d AS (SELECT profile_id, affiliation AS place, coalesce({_KEY.format(c="display_name")}, '') AS k FROM author_profiles WHERE affiliation IS NOT NULL),
o AS (SELECT professor_id, institution AS place, coalesce({_KEY.format(c="full_name")}, '') AS k FROM professors WHERE institution IS NOT NULL),
d1 AS (SELECT *, row_number() OVER (PARTITION BY place, k ORDER BY profile_id) AS n FROM d),
o1 AS (SELECT *, row_number() OVER (PARTITION BY place, k ORDER BY professor_id) AS n FROM o),
t1 AS (SELECT profile_id, professor_id FROM d1 JOIN o1 USING (place, k, n)),
d2 AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY profile_id) AS n FROM d WHERE profile_id NOT IN (SELECT profile_id FROM t1)),
o2 AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY professor_id) AS n FROM o WHERE professor_id NOT IN (SELECT professor_id FROM t1))
SELECT profile_id, professor_id, 1 AS tier FROM t1 UNION ALL SELECT profile_id, professor_id, 2 AS tier FROM d2 JOIN o2 USING (place, n)
"""


def reconcile_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and year keys of papers that no document's record has (by its paper)."""
    t = Tables(spark, sf_dir)
    keys = t.papers.select("paper_id", _plain_key("title").alias("title_key"), "publication_year")
    used = keys.join(t.documents.select("paper_id"), "paper_id", "left_semi")
    return J.missing_keys(keys, used, ["title_key", "publication_year"])


SQL_ANTI = f"""
WITH k AS (SELECT paper_id, {_KEY.format(c="title")} AS title_key, publication_year FROM papers),
u AS (SELECT * FROM k WHERE paper_id IN (SELECT paper_id FROM documents WHERE paper_id IS NOT NULL))
SELECT DISTINCT title_key, publication_year FROM k
WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.title_key IS NOT DISTINCT FROM k.title_key AND u.publication_year IS NOT DISTINCT FROM k.publication_year)
"""


def tiered_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles matched by ORCID cell, then by name and institution, then by name, else missing."""
    t = Tables(spark, sf_dir)
    rows = t.author_profiles.select("profile_id", "orcid", F.col("affiliation").alias("place"), _plain_key("display_name").alias("name_key"))
    targets = t.professors.select("professor_id", "orcid", F.col("institution").alias("place"), _plain_key("full_name").alias("name_key"))
    return J.tiered_match(rows, "profile_id", targets, "professor_id", [("orcid", ["orcid"]), ("name_place", ["name_key", "place"]), ("name", ["name_key"])])


SQL_TIERED = f"""
WITH r AS (SELECT profile_id, orcid, affiliation AS place, {_KEY.format(c="display_name")} AS k FROM author_profiles),
t AS (SELECT professor_id, orcid, institution AS place, {_KEY.format(c="full_name")} AS k FROM professors),
m AS (SELECT r.profile_id, (SELECT min(professor_id) FROM t WHERE t.orcid = r.orcid) AS a,
  (SELECT min(professor_id) FROM t WHERE t.k = r.k AND t.place = r.place) AS b, (SELECT min(professor_id) FROM t WHERE t.k = r.k) AS c FROM r)
SELECT profile_id, coalesce(a, b, c) AS professor_id,
  CASE WHEN a IS NOT NULL THEN 'orcid' WHEN b IS NOT NULL THEN 'name_place' WHEN c IS NOT NULL THEN 'name' ELSE 'missing' END AS tier FROM m
"""


def inventory_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document by its latest ingestion run: missing, processed, pending, failed or unknown."""
    t = Tables(spark, sf_dir)
    runs = t.ingestion_runs.where("document_id is not null").groupBy("document_id").agg(F.max_by("status", F.struct("started_at", "ingestion_id", "status")).alias("status"))
    runs = runs.select(F.col("document_id").alias("doc_id"), "status")
    states = {"processed": ["completed", "success", "done", "processed"], "pending": ["pending", "running", "started", "queued"], "failed": ["failed", "error"]}
    return Q.inventory(t.documents, runs, "doc_id", "status", states)


SQL_INVENTORY = """
WITH l AS (SELECT document_id, arg_max(status, struct_pack(s := started_at, i := ingestion_id, t := status)) AS status FROM ingestion_runs WHERE document_id IS NOT NULL GROUP BY document_id)
SELECT d.doc_id, CASE WHEN l.document_id IS NULL THEN 'missing'
  WHEN lower(trim(l.status)) IN ('completed','success','done','processed') THEN 'processed'
  WHEN lower(trim(l.status)) IN ('pending','running','started','queued') THEN 'pending'
  WHEN lower(trim(l.status)) IN ('failed','error') THEN 'failed' ELSE 'unknown' END AS class
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN l ON l.document_id = d.doc_id
"""


def nullsafe_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers for which a record with a DOI cell has the same title key and year (or none, both)."""
    t = Tables(spark, sf_dir)
    k = t.papers.select("paper_id", "doi", _plain_key("title").alias("title_key"), "publication_year")
    return J.exists_null_safe(k, k.where("doi <> ''"), ["title_key", "publication_year"]).select("paper_id")


SQL_NULLSAFE = f"""
WITH k AS (SELECT paper_id, doi, {_KEY.format(c="title")} AS title_key, publication_year FROM papers)
SELECT paper_id FROM k WHERE EXISTS (SELECT 1 FROM k o WHERE o.doi <> '' AND o.title_key IS NOT DISTINCT FROM k.title_key AND o.publication_year IS NOT DISTINCT FROM k.publication_year)
"""


def variant_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Professors and profiles that share a spelling of an identifier."""
    t = Tables(spark, sf_dir)
    bare = lambda c: F.nullif(F.regexp_replace(F.lower(c), "[^0-9x]", ""), F.lit(""))
    p = t.professors.select("professor_id", F.array_compact(F.array(F.col("orcid"), bare("orcid"), F.col("semantic_scholar_id"))).alias("v"))
    q = t.author_profiles.select("profile_id", F.array_compact(F.array(F.col("orcid"), bare("orcid"), F.col("scholar_ref"))).alias("v"))
    return J.variant_overlap(p, "professor_id", "v", q, "profile_id", "v")


SQL_VARIANTS = """
WITH p AS (SELECT professor_id, unnest([orcid, nullif(regexp_replace(lower(orcid), '[^0-9x]', '', 'g'), ''), semantic_scholar_id]) AS v FROM professors),
q AS (SELECT profile_id, unnest([orcid, nullif(regexp_replace(lower(orcid), '[^0-9x]', '', 'g'), ''), scholar_ref]) AS v FROM author_profiles)
SELECT DISTINCT professor_id, profile_id FROM p JOIN q USING (v)
"""


def box_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an order whose spans of time (a day for each piece) and price overlap an earlier line's."""
    t = Tables(spark, sf_dir)
    day = F.unix_date(F.to_date("l_shipdate"))
    boxes = t.lineitem.select("l_orderkey", "l_linenumber", day.alias("x0"), (day + F.col("l_quantity")).alias("x1"), F.col("l_extendedprice").alias("y0"), (F.col("l_extendedprice") + 1000 * F.col("l_quantity")).alias("y1"))
    return J.box_overlaps(boxes, "l_orderkey", "l_linenumber")


SQL_BOXES = """
WITH r AS (SELECT l_orderkey, l_linenumber, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS x0, l_quantity AS w, l_extendedprice AS y0, l_extendedprice + 1000 * l_quantity AS y1 FROM lineitem)
SELECT a.l_orderkey, a.l_linenumber AS a, b.l_linenumber AS b FROM r a JOIN r b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber
AND a.x0 < b.x0 + b.w AND b.x0 < a.x0 + a.w AND a.y0 < b.y1 AND b.y0 < a.y1
"""


def suspicious_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles with one scholar reference whose names do not contain one another."""
    t = Tables(spark, sf_dir)
    rows = t.author_profiles.select("profile_id", F.nullif(F.regexp_replace("scholar_ref", "[^0-9]", ""), F.lit("")).alias("ref"), F.coalesce(_plain_key("display_name"), F.lit("")).alias("name_key"))
    return J.disagreeing(rows, "ref", "profile_id", "name_key")


SQL_SUSPICIOUS = f"""
WITH r AS (SELECT profile_id, nullif(regexp_replace(scholar_ref, '[^0-9]', '', 'g'), '') AS ref, coalesce({_KEY.format(c="display_name")}, '') AS k FROM author_profiles)
SELECT a.ref, a.profile_id AS a, b.profile_id AS b FROM r a JOIN r b ON a.ref = b.ref AND a.profile_id < b.profile_id AND NOT contains(a.k, b.k) AND NOT contains(b.k, a.k)
"""


def parameter_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All combinations of region, nation and order priority."""
    t = Tables(spark, sf_dir)
    return J.sweep(t.region.select("r_name"), t.nation.select("n_name"), t.orders.select("o_orderpriority").distinct())


SQL_SWEEP = "SELECT r_name, n_name, o_orderpriority FROM region, nation, (SELECT DISTINCT o_orderpriority FROM orders)"


def department_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Professors whose institution is not their department's, case and outer spaces aside."""
    t = Tables(spark, sf_dir)
    d = t.departments.select("department_id", F.col("institution").alias("department_institution"))
    p = t.professors.join(d, "department_id", "left")
    fold = lambda c: F.lower(F.trim(c))
    return p.where(fold("institution") != fold("department_institution")).select("professor_id", "institution", "department_institution")


SQL_CONFLICTS = """
SELECT p.professor_id, p.institution, d.institution AS department_institution FROM professors p LEFT JOIN departments d USING (department_id)
WHERE lower(trim(p.institution)) <> lower(trim(d.institution))
"""


def overlay_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harvest source ranks laid over the names that papers give, with what is unknown or without a node."""
    t = Tables(spark, sf_dir)
    slots = t.harvest_sources.select(F.col("source_name").alias("name"), F.col("source_id").alias("node"), F.col("source_kind").alias("field"), F.lit(False).alias("is_link"))
    values = t.papers.where("source_name is not null").select(F.col("source_name").alias("name")).distinct().withColumn("value", F.length("name"))
    return J.overlay(values, slots, "name", "value")


SQL_OVERLAY = """
SELECT v.name, s.source_id AS node, s.source_kind AS field, length(v.name) AS value, CASE WHEN s.source_name IS NULL THEN 'unknown' ELSE 'set' END AS status
FROM (SELECT DISTINCT source_name AS name FROM papers WHERE source_name IS NOT NULL) v LEFT JOIN harvest_sources s ON s.source_name = v.name
"""


QUERIES = {
    f.__name__: f
    for f in (
        ordered_children_semi, left_chain, lookup_fallback, unique_candidate_match, self_match_exclusion, occurrence_pairing, queue_tiers, reconcile_anti, tiered_match,
        inventory_diff, nullsafe_exists, variant_overlap, box_overlaps, suspicious_pairs, parameter_sweep, department_conflicts, overlay_values,
    )
}
SQL = {
    "ordered_children_semi": SQL_ORDERED_CHILDREN, "left_chain": SQL_LEFT_CHAIN, "lookup_fallback": SQL_LOOKUP, "unique_candidate_match": SQL_UNIQUE, "self_match_exclusion": SQL_SELF,
    "occurrence_pairing": SQL_PAIRING, "queue_tiers": SQL_TIERS, "reconcile_anti": SQL_ANTI, "tiered_match": SQL_TIERED, "inventory_diff": SQL_INVENTORY, "nullsafe_exists": SQL_NULLSAFE,
    "variant_overlap": SQL_VARIANTS, "box_overlaps": SQL_BOXES, "suspicious_pairs": SQL_SUSPICIOUS, "parameter_sweep": SQL_SWEEP, "department_conflicts": SQL_CONFLICTS, "overlay_values": SQL_OVERLAY,
}
