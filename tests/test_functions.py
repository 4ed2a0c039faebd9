"""Scalar functions against definitions in plain Python."""

import difflib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stemma.functions import geo as G
from stemma.functions import text as X
from stemma.functions import unicode as U


def each(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r.x for r in df.select("i", f(F.col("c")).alias("x")).orderBy("i").collect()]


PROBES = ["  a\tb ", "It's “quoted” – Núñez", "", None, "  ", "ß STRASSE", "10.5555/AB.1.", "naïve", "a—b"]


def test_white_space_and_keys(spark):
    assert each(spark, PROBES, X.clean_string)[:5] == ["a\tb", "It's “quoted” – Núñez", None, None, None]
    assert each(spark, PROBES, X.collapsed)[0] == "a b"
    key = lambda s: None if s is None else " ".join(re.sub(r"[^a-z0-9]+", " ", re.sub("['\"’‘“”`]", "", s.lower())).split()) or None
    assert each(spark, PROBES, X.title_key) == [key(s) for s in PROBES]
    assert each(spark, ["It's"], X.title_key_apart) == ["it s"]


def test_doi_year_url(spark):
    cells = ["10.5555/AB.1", "https://doi.example/10.5555/ab.1.", "DOI: 10.5555/ab.1;", "see 10.5555/ab.1 there", "10.5555", "", None, "10.xxxx/y"]
    assert each(spark, cells, X.doi) == ["10.5555/ab.1"] * 4 + [None] * 4
    assert each(spark, ["doi:10.5555/A", "https://doi.example/10.5555/A", None], X.doi_bare) == ["10.5555/a", "10.5555/a", None]
    df = spark.createDataFrame([(None, "x http://h/10.5555/q"), ("n/a", None), ("10.5555/a", "10.5555/b")], "doi string, url string")
    assert [tuple(r) for r in df.select(X.recovered_doi("doi", "url"), X.recovered_from(["doi", "url"])).collect()] == [("10.5555/q", "url"), (None, None), ("10.5555/a", "doi")]
    assert each(spark, ["in 2020_", "c. 1999-2001", "12020", None], X.year) == [None, 1999, None, None]
    assert each(spark, [" 2020 ", "2_020", "x", None], X.year_int) == [2020, None, None, None]
    assert each(spark, ["HTTPS://a.b/c", "http://", "ftp://x", None], X.is_full_url) == [True, False, False, False]
    assert each(spark, ["http://a/b/#f", "http://a/?q=1", " "], X.url_key) == ["http://a/b", "http://a/?q=1", None]


def test_small_parsers(spark):
    assert each(spark, ["Yes", "0", "maybe", None], X.boolean) == [True, False, None, None]
    assert each(spark, ["Mary Ann Lee", "Plato"], X.name_parts) == [("Mary", "Lee", "MAL"), ("Plato", "Plato", "P")]
    assert each(spark, ["<p>a&nbsp;&lt;b&gt; &amp;amp;</p>\n c", None], X.without_tags) == ["a <b> &amp; c", None]
    assert each(spark, ["Mon, 02 Jan 2023 03:04:05 +0100", "2023-01-02T03:04:05Z", "soon", None], X.iso_moment) == ["2023-01-02T02:04:05+00:00", "2023-01-02T03:04:05+00:00", "soon", None]
    assert each(spark, ["One two three four. Short. No.\n# Heading of four words.\nFive is a number too!"], X.sentences) == [["One two three four.", "Five is a number too!"]]
    assert each(spark, ["a [1] b [12][1] [x]"], X.citation_ids) == [[1, 12, 1]]
    assert each(spark, ["[[A|b]] [[C#d]] [e]"], X.links) == [["A", "C"]]
    assert each(spark, ['<link rel="alternate" type="application/rss+xml" href="/f.xml"><link type="text/css" href="s">'], X.html_links) == [["/f.xml"]]
    assert each(spark, ['{"a"', "<?xml?><rss>", "<!DOCTYPE html>", "x"], X.feed_kind) == ["json", "xml", "html", None]
    assert each(spark, ["https://youtu.be/abcdefghijk?t=1", "https://x/watch?v=abcdefghijk", "abcdefghijk", "short"], X.video_id) == ["abcdefghijk"] * 3 + [None]
    assert each(spark, ["1-3,5,9-", "2", "4-2", "0", "x", "11"], lambda c: X.page_numbers(c, 10)) == [[1, 2, 3, 5, 9, 10], [2], None, None, None, None]
    assert each(spark, ["7", "123456789"], X.zero_filled) == ["00000007", "123456789"]
    assert each(spark, ["true", "12", "1.5e3", "2024-02-30", "2024-02-03", "2024-02-03T04:05", "3,5", "", None], X.coerced) == ["bool", "int", "float", "string", "date", "datetime", "string", None, None]
    assert each(spark, [59, 61, 3700], X.clock_text, "int") == ["0:59", "1:01", "1:01:40"]
    assert each(spark, [999.4, 1500.0], X.distance_text, "double") == ["999 m", "1.5 km"]
    assert each(spark, [5, 60, 3660], X.duration_text, "int") == ["5 s", "1 min", "1h 1min"]
    df = spark.createDataFrame([("the *Quick* “brown” fox", "He saw the quick brown fox."), ("two words", "two words"), (None, "x")], "q string, t string")
    assert [r.x for r in df.select(X.quoted_in("q", "t").alias("x")).collect()] == [True, False, False]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=30))
def test_unicode_keys_are_idempotent(s):
    for f in (U.compat_lower_text, U.key_text, U.folded_text, U.compat_folded_text):
        once = f(s)
        assert f(once) == once or f is U.compat_lower_text


def test_unicode(spark):
    assert U.key_text("Núñez-O’Neil") == "nunez oneil" and U.key_or_original("研究") == "研究" and U.folded_text("Straße") == "strasse"
    assert U.marks_apart_text("Núñez") != U.key_text("Núñez")
    assert each(spark, ['{"b":1,"a":[1, null]}', "{", None], U.canonical_json) == ['{"a":[1,null],"b":1}', None, None]
    df = spark.createDataFrame([("abcd", "bcde"), (None, "x")], "a string, b string")
    assert [r.x for r in df.select(U.ratio("a", "b").alias("x")).collect()] == [pytest.approx(difflib.SequenceMatcher(None, "abcd", "bcde").ratio()), None]


@pytest.mark.parametrize(
    "formula,axis,at,by,want",
    [("=A1+B5", "row", 3, 2, "=A1+B7"), ("=$B$5", "row", 5, -1, "=#REF!"), ("=B6", "row", 5, -1, "=B5"), ('="B9"&B9', "row", 2, 1, '="B9"&B10'), ("=SUM(Z1:AA1)", "column", 27, 1, "=SUM(Z1:AB1)"), ("=LOG10(A1)", "row", 1, 1, "=LOG10(A2)"),
     ("=SUM(A1:A10)", "row", 1, -2, "=SUM(A1:A8)"), ("=SUM(A3:A5)", "row", 3, -3, "=SUM(#REF!)"), ("=SUM(B$2:D4)", "column", 3, -2, "=SUM(B$2:B4)"), ("=Data!B7+'My Data'!B7+Other!B7", "row", 2, 1, "=Data!B8+'My Data'!B7+Other!B7"), ("=SUM(A:A)", "row", 1, 1, "=SUM(A:A)")],
)
def test_formulas_move(formula, axis, at, by, want):
    assert U.shifted_formula(formula, axis, at, by, sheet="data") == want


def test_geo(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (2.0, 0.0)], "lat double, lon double")
    d = [round(r.x, 2) for r in df.select(G.haversine(F.lit(0.0), F.lit(0.0), F.col("lat"), F.col("lon")).alias("x")).collect()]
    assert d == [0.0, 111194.93, 222389.85]
    assert df.where(G.within(F.col("lat"), F.col("lon"), (0.0, 0.0), 112_000)).count() == 2
    assert df.where(G.in_box(F.col("lat"), F.col("lon"), (3.0, 1.0), (1.0, -1.0))).count() == 1
    assert df.limit(1).select(G.box_size(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("s")).first().s.height_m == 111194.9
