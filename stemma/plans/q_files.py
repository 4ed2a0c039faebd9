"""Queries through files written from the tables and read back, and functions over prepared values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.functions import geo as G
from stemma.functions import text as X
from stemma.functions import unicode as U
from stemma.operators import cited as C
from stemma.operators import quality as Q
from stemma.plans.tables import Tables
from stemma.session import scratch_path
from stemma.sources import artifacts as A


def artifact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics written as JSON and read with their declared schema."""
    t = Tables(spark, sf_dir).topics.select("topic_id", "topic_name", "description", "parent_topic_id")
    path = scratch_path(spark, "artifact")
    A.write_artifact(t, path)
    return spark.read.schema(t.schema).json(path)


SQL_ARTIFACT = "SELECT topic_id, topic_name, description, parent_topic_id FROM topics"


def artifact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harvest sources as one JSON document a file, read with a declared schema."""
    s = Tables(spark, sf_dir).harvest_sources.select("source_id", F.struct("source_name", "trust_rank").alias("source"))
    path = scratch_path(spark, "documents")
    s.select(F.to_json(F.struct("source_id", "source"), {"pretty": "true"}).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return A.read_artifact(spark, path, "source_id int, source struct<source_name: string, trust_rank: int>").select("source_id", "source.*")


SQL_DOCUMENTS = "SELECT source_id, source_name, trust_rank FROM harvest_sources"


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion runs appended to a log, with broken lines in between, and read back."""
    r = Tables(spark, sf_dir).ingestion_runs.select("ingestion_id", "status").distinct()
    path = scratch_path(spark, "log")
    line = F.when(F.col("ingestion_id") % 50 == 0, F.concat(F.lit('{"ingestion_id": '), F.col("ingestion_id").cast("string"))).otherwise(F.to_json(F.struct("ingestion_id", "status")))
    r.where("ingestion_id % 2 = 0").select(line.alias("value")).write.text(path)
    A.append_log(r.where("ingestion_id % 2 = 1"), path)
    log = A.read_log(spark, path, "ingestion_id bigint, status string")
    # lines of a file are numbered without gaps
    whole = log.groupBy("file").agg((F.max("line") == F.count(F.lit(1))).alias("whole"))
    return log.join(whole, "file").select(F.when(F.col("bad").isNull(), F.col("ingestion_id")).alias("ingestion_id"), F.when(F.col("bad").isNull(), F.col("status")).alias("status"), "bad", "whole")


SQL_LOG = """
SELECT CASE WHEN ingestion_id % 50 <> 0 THEN ingestion_id END AS ingestion_id, CASE WHEN ingestion_id % 50 <> 0 THEN status END AS status,
  CASE WHEN ingestion_id % 50 = 0 THEN '{"ingestion_id": ' || ingestion_id END AS bad, true AS whole FROM (SELECT DISTINCT ingestion_id, status FROM ingestion_runs)
"""


def delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers written as delimited text, with quotes, delimiters and line breaks in cells, and read back as text."""
    p = Tables(spark, sf_dir).papers.select("paper_id", F.nullif("title", F.lit("")).alias("title"), F.nullif("keywords", F.lit("")).alias("keywords"), "publication_year")
    path = scratch_path(spark, "csv")
    A.write_delimited(p, path)
    return A.read_delimited(spark, path)


SQL_DELIMITED = "SELECT CAST(paper_id AS VARCHAR) AS paper_id, nullif(title, '') AS title, nullif(keywords, '') AS keywords, CAST(publication_year AS VARCHAR) AS publication_year FROM papers"


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year and title of manifest lines."""
    p = Tables(spark, sf_dir).papers.where(~F.col("title").rlike(r"[\r\n]"))
    path = scratch_path(spark, "manifest")
    p.select(F.concat(F.coalesce(F.col("publication_year").cast("string"), F.lit("undated")), F.lit(" | "), "title").alias("value")).write.text(path)
    return A.read_manifest(spark, path)


SQL_MANIFEST = r"SELECT publication_year AS year, trim(title) AS title FROM papers WHERE NOT regexp_matches(title, '[\r\n]')"


def file_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 and length of files that hold one source's name each."""
    path = scratch_path(spark, "files")
    Tables(spark, sf_dir).harvest_sources.select("source_name").write.option("maxRecordsPerFile", 1).text(path)
    sizes = A.files(spark, path, "*.txt").select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")
    hashes = A.file_hashes(spark, path, "*.txt").select(F.element_at(F.split("path", "/"), -1).alias("name"), "sha256")
    return sizes.join(hashes, "name").select("length", "sha256")


SQL_HASHES = "SELECT CAST(octet_length(encode(source_name)) + 1 AS BIGINT) AS length, sha256(source_name || chr(10)) AS sha256 FROM harvest_sources"


def paged_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents listed by pages of fifty with the total: items by status, and whether they are complete."""
    d = Tables(spark, sf_dir).documents.select("doc_id", "document_type").distinct()
    n = d.agg(F.count(F.lit(1)).alias("total"))
    paged = d.groupBy(F.floor(F.col("doc_id") / 50).alias("page")).agg(F.collect_list(F.struct("doc_id", "document_type")).alias("documents")).join(F.broadcast(n))
    items, counts = A.pages(paged.select(F.to_json(F.struct("documents", "total")).alias("body")), "$.documents", "$.total")
    kinds = items.select(F.get_json_object("item", "$.document_type").alias("document_type")).groupBy("document_type").agg(F.count(F.lit(1)).alias("n"))
    return kinds.join(F.broadcast(counts.select((F.col("n_items") == F.col("n_expected")).alias("complete"))))


SQL_PAGED = "SELECT document_type, count(*) AS n, true AS complete FROM (SELECT DISTINCT doc_id, document_type FROM documents) GROUP BY 1"


def index_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of an index entry, else the entry's own key."""
    p = Tables(spark, sf_dir).papers
    entry = lambda k, c: F.struct(F.lit(k).alias("key"), F.col(c).cast("string").alias("text"), F.concat(F.lit("k"), F.col("paper_id").cast("string")).alias("entry_key"))
    entries = F.array(entry("venue", "venue"), entry("year", "publication_year"), entry("venue", "publisher"))
    return p.select("paper_id", A.index_value(entries, "venue").alias("venue"), A.index_value(entries, "year").alias("year"), A.index_value(entries, "none").alias("none"))


SQL_INDEX = "SELECT paper_id, coalesce(nullif(venue, ''), 'k' || paper_id) AS venue, coalesce(CAST(publication_year AS VARCHAR), 'k' || paper_id) AS year, CAST(NULL AS VARCHAR) AS none FROM papers"


def same_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded and present hashes of the texts: those that differ, were removed or are new."""
    d = Tables(spark, sf_dir).documents.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h")).distinct()
    recorded = d.where("doc_id % 10 <> 1").select("doc_id", F.when(F.col("doc_id") % 10 == 2, F.lit("0")).otherwise(F.col("h")).alias("h"))
    return Q.difference(recorded, d.where("doc_id % 10 <> 3"), ["doc_id", "h"]).select("doc_id", "side")


SQL_SAME = "SELECT doc_id, 'missing' AS side FROM (SELECT DISTINCT doc_id FROM documents) WHERE doc_id % 10 IN (2, 3) UNION ALL SELECT doc_id, 'extra' FROM (SELECT DISTINCT doc_id FROM documents) WHERE doc_id % 10 IN (1, 2)"


# Prepared values: name, input, what must come out.
_TEXTS: tuple[tuple[str, str, str | None], ...] = (
    ("compat_lower", "Ｗｅａｒ  of ﬁbres", "wear of fibres"), ("compat_lower", "ÉTÉ ½", "été 1⁄2"), ("compat_lower", "Straße", "straße"),
    ("marks_apart", "Núñez-Oh", "nu n ez oh"), ("marks_apart", "A.B. Ōe", "a b o e"),
    ("key", "Núñez-O’Neil", "nunez oneil"), ("key", "研究", ""), ("key", "Ångström (1)", "angstrom 1"),
    ("key_kept", "研究", "研究"), ("key_kept", "Núñez", "nunez"), ("case_folded", " Straße  X ", "strasse x"), ("compat_folded", "ＳＴＲＡßＥ", "strasse"),
    ("unescaped", "a &amp; b &lt;c&gt; &#233;", "a & b <c> é"), ("canonical_json", '{"b": 1, "a": [1, null]}', '{"a":[1,null],"b":1}'), ("canonical_json", "{", None),
    ("json_hash", '{ "a" : 1 }', "015abd7f5cc57a2dd94b7590f04ad8084273905ee33ec5cebeae62276a97f862"),
    ("boolean", " Yes ", "true"), ("boolean", "F", "false"), ("boolean", "maybe", None), ("year_int", " 2024 ", "2024"), ("year_int", "2024a", None), ("safe_int", "-7", "-7"), ("safe_int", "7.5", None),
    ("duration", "59", "59 s"), ("duration", "61", "1 min"), ("duration", "7261", "2h 1min"), ("clock", "65", "1:05"), ("clock", "3723", "1:02:03"), ("distance", "950", "950 m"), ("distance", "1550", "1.6 km"),
    ("video_id", "https://youtu.be/abcDEF12345?t=3", "abcDEF12345"), ("video_id", "https://video.example/watch?v=abc_EF-2345&x=1", "abc_EF-2345"), ("video_id", "abc", None),
    ("page_numbers", "1-3, 5,9-", "1,2,3,5,9,10"), ("page_numbers", "4-2", None), ("page_numbers", "11", None), ("sentences", "# Head\nOne two three four. Too short. Five six seven eight!", "One two three four.~Five six seven eight!"),
    ("file_name", "A: b/c " + "x" * 300, "A_b_c_" + "x" * 300 + ".pdf"), ("doi", "see https://doi.org/10.1234/AbC.5;.", "10.1234/abc.5"), ("match_key", "“A *B*”  c", "a b c"), ("joined_url", "../x?y=1", "https://a.example/x?y=1"),
    ("row_formula", "=SUM(A1:A10)", "=SUM(A1:A8)"), ("row_formula", "=A2+$B$9", "=#REF!+$B$7"), ("row_formula", '="A9"&Data!C9', '="A9"&Data!C9'), ("column_formula", "=LOG10(AA1)+Z1", "=LOG10(AB1)+Z1"), ("feed_kind", "<?xml version='1.0'?><rss>", "xml"), ("feed_kind", " {", "json"),
)
_FUNCTIONS = {
    "compat_lower": U.compat_lower, "marks_apart": U.marks_apart, "key": U.key, "key_kept": U.key_kept, "case_folded": U.case_folded, "compat_folded": U.compat_folded, "unescaped": U.unescaped, "canonical_json": U.canonical_json,
    "json_hash": U.json_hash, "boolean": X.boolean, "year_int": X.year_int, "safe_int": X.safe_int, "duration": X.duration_text, "clock": X.clock_text, "distance": lambda c: X.distance_text(c.cast("double")), "video_id": X.video_id,
    "page_numbers": lambda c: F.array_join(X.page_numbers(c, 10), ","), "sentences": lambda c: F.array_join(X.sentences(c), "~"), "file_name": X.file_name, "doi": X.doi, "match_key": X.match_key,
    "joined_url": lambda c: U.joined_url(F.lit("https://a.example/b/c"), c), "row_formula": U.shift_formula("row", 1, -2), "column_formula": U.shift_formula("column", 27, 1), "feed_kind": X.feed_kind,
}


def function_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Functions over prepared values: ``name, place, value``."""
    rows = spark.createDataFrame([(n, i, x) for i, (n, x, _) in enumerate(_TEXTS)], "name string, place int, x string")
    value: Column = F.lit(None).cast("string")
    parts = [rows.where(F.col("name") == n).select("name", "place", f(F.col("x")).cast("string").alias("value")) for n, f in _FUNCTIONS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("name", "place", F.coalesce("value", value).alias("value"))


def _quoted(s: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if s is None else "'" + s.replace("'", "''") + "'"


SQL_FUNCTIONS = "SELECT * FROM (VALUES " + ", ".join(f"('{n}', {i}, {_quoted(y)})" for i, (n, _, y) in enumerate(_TEXTS)) + ") AS t(name, place, value)"

# Two texts, and their similarity as twice the letters of common blocks by all letters.
_PAIRS = (("abcd", "bcde", 6, 8), ("wear of weirs", "wear of weir", 24, 25), ("", "", 1, 1), ("abc", "xyz", 0, 6), ("tide", "diet", 2, 8), ("diet", "tide", 4, 8))


def similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of prepared pairs, which depends on their order."""
    df = spark.createDataFrame([(a, b) for a, b, _, _ in _PAIRS], "a string, b string")
    return df.select("a", "b", F.round(U.ratio("a", "b"), 6).alias("similarity"))


SQL_SIMILAR = "SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', round(CAST({x} AS DOUBLE) / {y}, 6))" for a, b, x, y in _PAIRS) + ") AS t(a, b, similarity)"


def box_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width and height of boxes between places drawn from the embeddings' first values."""
    n = Tables(spark, sf_dir).nation.select("n_nationkey", (F.col("n_nationkey") * 2.0 - 20).alias("s"), (F.col("n_regionkey") * 10.0).alias("w"))
    size = G.box_size(F.col("s"), F.col("w"), F.col("s") + 1.5, F.col("w") + 0.5)
    return n.select("n_nationkey", F.round(size["height_m"], 0).cast("bigint").alias("height"))


SQL_BOX_SIZE = "SELECT n_nationkey, CAST(round(1.5 * pi() / 180 * 6371000, 0) AS BIGINT) AS height FROM nation"


def sentence_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of four words or more of each note, outside fences and headings, and those that cite."""
    return C.coverage(Tables(spark, sf_dir).documents.where("document_type = 'note'").select("doc_id", "text"))


SQL_SENTENCES = r"""
WITH l AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line, generate_subscripts(regexp_split_to_array(text, '\r?\n'), 1) AS n FROM documents WHERE document_type = 'note'),
f AS (SELECT *, sum(CASE WHEN regexp_matches(line, '^\s*(```|~~~)') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS k FROM l),
p AS (SELECT doc_id, n, line FROM f WHERE k % 2 = 0 AND NOT regexp_matches(line, '^\s*(```|~~~)') AND NOT regexp_matches(line, '^\s*(#|\||>)')),
s AS (SELECT doc_id, unnest(string_split(regexp_replace(line, '([.!?])\s+([^\[\s])', '\1' || chr(1) || '\2', 'g'), chr(1))) AS s FROM p)
SELECT doc_id, count(*) AS n_sentences, count(*) FILTER (WHERE regexp_matches(s, '\[[0-9]+\]')) AS n_cited FROM s WHERE len(regexp_split_to_array(trim(s), '\s+')) >= 4 GROUP BY doc_id
"""

_ALL = (artifact_roundtrip, artifact_files, log_lines, delimited_roundtrip, manifest_lines, file_hashes, paged_inventory, index_values, same_hashes, function_values, similarities, box_sizes, sentence_coverage)
QUERIES = {f.__name__: f for f in _ALL}
SQL = dict(
    artifact_roundtrip=SQL_ARTIFACT, artifact_files=SQL_DOCUMENTS, log_lines=SQL_LOG, delimited_roundtrip=SQL_DELIMITED, manifest_lines=SQL_MANIFEST, file_hashes=SQL_HASHES, paged_inventory=SQL_PAGED, index_values=SQL_INDEX,
    same_hashes=SQL_SAME, function_values=SQL_FUNCTIONS, similarities=SQL_SIMILAR, box_sizes=SQL_BOX_SIZE, sentence_coverage=SQL_SENTENCES,
)
