"""Queries over feeds, landed answers, workflows, batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.operators import filters as P
from stemma.operators import graph as R
from stemma.operators import workflow as W
from stemma.plans.tables import Tables
from stemma.session import scratch_path
from stemma.sources import artifacts as A
from stemma.sources import feeds as E
from stemma.streaming import incremental as I


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of RSS texts rendered from papers and read back."""
    p = Tables(spark, sf_dir).papers
    text = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = F.concat(F.lit('<?xml version="1.0"?><rss><channel><item><title>'), text("venue"), F.lit("</title><link>"), text("source_url"), F.lit("</link><pubDate>"), F.coalesce(F.date_format("publication_date", "dd MMM yyyy"), F.lit("")), F.lit("</pubDate></item></channel></rss>"))
    return E.entries(p.select("paper_id", body.alias("body")), ("paper_id",)).select("paper_id", "title", "link", F.left("published", F.lit(10)).alias("published"))


SQL_FEED = "SELECT paper_id, nullif(trim(venue), '') AS title, nullif(trim(source_url), '') AS link, strftime(publication_date, '%Y-%m-%d') AS published FROM papers"


def json_feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of JSON feeds rendered from harvest sources and read back."""
    s = Tables(spark, sf_dir).harvest_sources
    item = F.struct(F.col("source_name").alias("title"), F.concat(F.lit("https://feed.example/"), F.col("source_id").cast("string")).alias("url"), F.lit("2024-01-02T03:04:05Z").alias("date_published"))
    feeds = s.groupBy("source_kind").agg(F.to_json(F.struct(F.lit("https://jsonfeed.org/version/1").alias("version"), F.collect_list(item).alias("items"))).alias("body"))
    return E.entries(feeds, ("source_kind",)).select("source_kind", "title", "link", "published")


SQL_JSON_FEED = "SELECT source_kind, source_name AS title, 'https://feed.example/' || source_id AS link, '2024-01-02T03:04:05+00:00' AS published FROM harvest_sources"


def landed_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed answers whose authors are an object if there is one and a list if there are more; some are JSON within JSON."""
    a = Tables(spark, sf_dir).authorships.select("paper_id", "authorship_id").distinct()
    people = F.collect_list(F.struct("authorship_id"))
    j = a.groupBy("paper_id").agg(F.when(F.count(F.lit(1)) == 1, F.concat(F.lit('{"authors":'), F.to_json(F.get(people, 0)), F.lit("}"))).otherwise(F.to_json(F.struct(people.alias("authors")))).alias("body"))
    body = F.when(F.length("body") > 100, F.concat(F.lit('"'), F.replace("body", F.lit('"'), F.lit('\\"')), F.lit('"'))).otherwise(F.col("body"))
    v = j.select("paper_id", A.parsed(body).alias("v"))
    items = v.select("paper_id", F.explode(A.as_list(F.try_variant_get("v", "$.authors", "variant"))).alias("item"))
    return items.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_authors"), F.min(F.get_json_object("item", "$.authorship_id").cast("bigint")).alias("first_id"))


SQL_LANDED = "SELECT paper_id, count(DISTINCT authorship_id) AS n_authors, min(authorship_id) AS first_id FROM authorships GROUP BY paper_id"


def _workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir).topics
    parent = F.concat(F.lit('["'), F.col("parent_topic_id").cast("string"), F.lit('", 0]'))
    inputs = F.map_filter(F.map_from_arrays(F.array(F.lit("parent"), F.lit("name")), F.array(parent, F.col("topic_name"))), lambda k, v: v.isNotNull())
    node = F.struct(F.lit("Topic").alias("class_type"), inputs.alias("inputs"))
    return t.groupBy(F.lit(1).alias("workflow_id")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("topic_id").cast("string").alias("k"), node.alias("v"))))).alias("graph"))


def workflow_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs of a workflow's nodes, links told from values (the topics as a graph in JSON)."""
    return W.inputs(W.nodes(_workflow(spark, sf_dir))).select("node", "field", F.when(F.col("link_to").isNull(), F.col("value")).alias("value"), "link_to")


SQL_INPUTS = """
SELECT CAST(topic_id AS VARCHAR) AS node, 'name' AS field, topic_name AS value, CAST(NULL AS VARCHAR) AS link_to FROM topics
UNION ALL SELECT CAST(topic_id AS VARCHAR), 'parent', NULL, CAST(parent_topic_id AS VARCHAR) FROM topics WHERE parent_topic_id IS NOT NULL
"""


def workflow_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The node that each link leads to when all nodes pass through."""
    links = W.inputs(W.nodes(_workflow(spark, sf_dir))).where("link_to is not null").select("node", F.col("link_to").alias("source"), F.lit("pass").alias("kind"))
    return R.traced(links, links.select(F.col("node").alias("start")), F.col("kind") == "pass")


SQL_TRACE = """
WITH RECURSIVE r AS (SELECT topic_id AS start, parent_topic_id AS target, 1 AS hops FROM topics WHERE parent_topic_id IS NOT NULL
  UNION ALL SELECT r.start, t.parent_topic_id, r.hops + 1 FROM r JOIN topics t ON t.topic_id = r.target WHERE t.parent_topic_id IS NOT NULL)
SELECT CAST(start AS VARCHAR) AS start, CAST(arg_max(target, hops) AS VARCHAR) AS target, CAST(max(hops) AS INTEGER) AS hops FROM r GROUP BY start
"""


def missing_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source names of papers that no harvest source meets in any spelling of a file's name."""
    t = Tables(spark, sf_dir)
    needs = t.papers.where("source_name <> ''").select(F.lit("s").alias("folder"), F.col("source_name").alias("model")).distinct()
    return W.missing_models(needs, t.harvest_sources.select(F.lit("s").alias("folder"), F.col("source_name").alias("model"))).select("model")


SQL_MODELS = "SELECT DISTINCT source_name AS model FROM papers WHERE source_name <> '' AND lower(source_name) NOT IN (SELECT lower(source_name) FROM harvest_sources)"


def missing_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsers of ingestion runs that are no kind of harvest source."""
    t = Tables(spark, sf_dir)
    nodes = t.ingestion_runs.where("parser is not null").select(F.lit(1).alias("workflow_id"), F.col("parser").alias("class_type"))
    return W.missing_classes(nodes, t.harvest_sources.select(F.col("source_kind").alias("class_type"))).select("class_type")


SQL_CLASSES = "SELECT DISTINCT parser AS class_type FROM ingestion_runs WHERE parser IS NOT NULL AND parser NOT IN (SELECT source_kind FROM harvest_sources WHERE source_kind IS NOT NULL)"


def document_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in batches of ten, in order of their ids, as a sink takes them."""
    return A.batched(Tables(spark, sf_dir).documents.select("doc_id"), ["doc_id"]).select("doc_id", "batch", "batch_place")


SQL_BATCHES = "SELECT doc_id, (r - 1) // 10 + 1 AS batch, CAST((r - 1) % 10 + 1 AS INTEGER) AS batch_place FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r FROM documents)"


def conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English full texts of some length: three of four possible conditions."""
    d = Tables(spark, sf_dir).documents
    return d.where(P.all_of([F.col("document_type") == "fulltext", F.col("lang") == "en", None, F.col("n_chars") >= 1000])).select("doc_id", "n_chars")


SQL_CONJUNCTION = "SELECT doc_id, n_chars FROM documents WHERE document_type = 'fulltext' AND lang = 'en' AND n_chars >= 1000"


def assembled_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of professors put together from their parts."""
    return Tables(spark, sf_dir).professors.select("professor_id", P.assembled("first_name", "middle_name", "last_name").alias("name"))


SQL_ASSEMBLED = "SELECT professor_id, nullif(concat_ws(' ', nullif(trim(first_name), ''), nullif(trim(middle_name), ''), nullif(trim(last_name), '')), '') AS name FROM professors"


def unsuppressed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs as alerts of their document: sent if the status changed, or after a day."""
    r = Tables(spark, sf_dir).ingestion_runs.where("document_id is not null and started_at is not null").select("ingestion_id", "document_id", "started_at", F.lower(F.trim("status")).alias("state")).distinct()
    return I.unsuppressed(r.fillna("", ["state"]), "document_id", "started_at", "state", 86400).select("ingestion_id", "document_id")


SQL_ALERTS = """
WITH r AS (SELECT DISTINCT ingestion_id, document_id, started_at, coalesce(lower(trim(status)), '') AS s FROM ingestion_runs WHERE document_id IS NOT NULL AND started_at IS NOT NULL),
l AS (SELECT *, lag(s) OVER w AS ps, lag(started_at) OVER w AS pt FROM r WINDOW w AS (PARTITION BY document_id ORDER BY started_at))
SELECT ingestion_id, document_id FROM l WHERE ps IS NULL OR ps <> s OR epoch_us(started_at) - epoch_us(pt) > 86400000000
"""


def polled_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of each document from the states its runs were seen in."""
    r = Tables(spark, sf_dir).ingestion_runs.where("document_id is not null")
    return I.settled(r, "document_id", "status", "started_at", ["completed", "failed", "success", "done"], 900).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


SQL_OUTCOMES = """
WITH r AS (SELECT document_id, lower(trim(status)) AS s, started_at FROM ingestion_runs WHERE document_id IS NOT NULL),
g AS (SELECT document_id, arg_min(s, started_at) FILTER (WHERE s IN ('completed','failed','success','done')) AS d, epoch_us(max(started_at)) - epoch_us(min(started_at)) AS w FROM r GROUP BY document_id)
SELECT coalesce(d, CASE WHEN w > 900000000 THEN 'timeout' ELSE 'waiting' END) AS outcome, count(*) AS n FROM g GROUP BY 1
"""


def incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as a stream, each id once, drained to a table and counted by type (an extension: nothing like it is in the surveyed tools)."""
    events = Tables(spark, sf_dir).events
    out, state = scratch_path(spark, "stream"), scratch_path(spark, "state")
    arriving = I.arriving(spark, f"{sf_dir}/events*.parquet", events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
    stream = I.first_only(arriving, ["event_id"], "ts", "3650 days")
    I.drained(stream, out, state)
    return spark.read.schema(stream.schema).parquet(out).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


SQL_EVENTS = "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY event_type"

_ALL = (
    feed_entries, json_feed_entries, landed_lists, workflow_inputs, workflow_trace, missing_models, missing_classes, document_batches, conjunction, assembled_names, unsuppressed_alerts, polled_outcomes, incremental_events,
)
QUERIES = {f.__name__: f for f in _ALL}
SQL = dict(
    feed_entries=SQL_FEED, json_feed_entries=SQL_JSON_FEED, landed_lists=SQL_LANDED, workflow_inputs=SQL_INPUTS, workflow_trace=SQL_TRACE, missing_models=SQL_MODELS, missing_classes=SQL_CLASSES, document_batches=SQL_BATCHES,
    conjunction=SQL_CONJUNCTION, assembled_names=SQL_ASSEMBLED, unsuppressed_alerts=SQL_ALERTS, polled_outcomes=SQL_OUTCOMES, incremental_events=SQL_EVENTS,
)
