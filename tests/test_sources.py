"""Sources, sinks and streams, by round trips."""

import json
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stemma.sources import artifacts as A
from stemma.sources import feeds as E
from stemma.sources import sheets as S
from stemma.streaming import incremental as I


def test_artifacts_and_variants(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"people": [{"id": 1}], "total": 2}))
    (tmp_path / "b.json").write_text(json.dumps(json.dumps({"people": {"id": 2}, "total": 2})))
    df = A.landed(spark, f"{tmp_path}/*.json")
    lists = df.select(A.as_list(F.try_variant_get(A.parsed(F.col("body")), "$.people", "variant")).alias("l"))
    assert sorted(x for r in lists.collect() for x in r["l"]) == ['{"id":1}', '{"id":2}']
    items, counts = A.pages(df.select(F.to_json(A.parsed(F.col("body"))).alias("body")), "$.people", "$.total")
    assert items.count() == 2 and tuple(counts.first()) == (2, 2)
    assert A.read_artifact(spark, f"{tmp_path}/a.json", "people array<struct<id: int>>, total int").first().people[0].id == 1
    out = spark.createDataFrame([(1, None)], "a int, b string")
    A.write_artifact(out, f"{tmp_path}/out")
    assert tuple(spark.read.schema("a int, b string").json(f"{tmp_path}/out").first()) == (1, None)
    e = spark.createDataFrame([([("k", "", "fallback"), ("k", "later", "")],)], "e array<struct<key: string, text: string, entry_key: string>>")
    assert e.select(A.index_value(F.col("e"), "k").alias("x")).first().x == "fallback"


def test_logs(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"n":1}\n\nbroken\n{"n":2}\n')
    assert [(r.line, r.n, r.bad) for r in A.read_log(spark, f"{tmp_path}/log.jsonl", "n int").orderBy("line").collect()] == [(1, 1, None), (3, None, "broken"), (4, 2, None)]
    A.append_log(spark.createDataFrame([(1,)], "n int"), f"{tmp_path}/more")
    A.append_log(spark.createDataFrame([(2,)], "n int"), f"{tmp_path}/more")
    assert spark.read.schema("n int").json(f"{tmp_path}/more").count() == 2


def test_delimited_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b\nc', datetime(2024, 1, 2)), (2, "é 1,5", datetime(2024, 1, 2, 3, 4, 5))], "i int, s string, t timestamp")
    A.write_delimited(df, f"{tmp_path}/csv", ";")
    assert {tuple(r) for r in A.read_delimited(spark, f"{tmp_path}/csv", ";").collect()} == {("1", 'a "q", b\nc', "2024-01-02"), ("2", "é 1,5", "2024-01-02T03:04:05")}
    (tmp_path / "m.txt").write_text("2001|A | b\n\nx|C\n")
    assert {tuple(r) for r in A.read_manifest(spark, f"{tmp_path}/m.txt").collect()} == {(2001, "A | b"), (None, "C")}
    assert [r.path.split("/")[-1] for r in A.files(spark, str(tmp_path), "*.txt").collect()] == ["m.txt"]
    assert len(A.file_hashes(spark, str(tmp_path), "*.txt").first().sha256) == 64
    b = A.batched(spark.createDataFrame([(i,) for i in range(25)], "i int"), ["i"], 10)
    assert {(r.batch, r.n) for r in b.groupBy("batch").agg(F.count("*").alias("n")).collect()} == {(1, 10), (2, 10), (3, 5)}


RSS = '<?xml version="1.0"?><rss><channel><item><title>A &amp; B</title><link>http://a</link><pubDate>Mon, 02 Jan 2023 03:04:05 GMT</pubDate><dc:creator>Ann</dc:creator><description><![CDATA[<p>Hi</p>]]></description></item></channel></rss>'
ATOM = '<feed xmlns="x"><entry><title type="text">T</title><link rel="self" href="http://s"/><link rel="alternate" href="http://t"/><updated>2023-01-03T00:00:00Z</updated><author><name>Bo</name></author><summary>S</summary></entry></feed>'
JSONF = json.dumps({"items": [{"title": "J", "id": "http://j", "date_published": "soon", "authors": [{"name": "Cy"}], "content_html": "<b>x</b>"}]})


def test_feeds(spark):
    df = spark.createDataFrame([("r", RSS), ("a", ATOM), ("j", JSONF), ("h", "<html></html>"), ("n", None)], "file string, body string")
    got = {r.file: tuple(r)[1:] for r in E.entries(df).collect()}
    assert got == {
        "r": ("A & B", "http://a", "2023-01-02T03:04:05+00:00", "Ann", "Hi"),
        "a": ("T", "http://t", "2023-01-03T00:00:00+00:00", "Bo", "S"),
        "j": ("J", "http://j", "soon", "Cy", "x"),
    }
    e = spark.createDataFrame([("x", "2023-01-01"), ("y", None), ("z", "2023-02-01")], "link string, published string")
    assert [r.link for r in E.since(e, None).collect()] == ["z", "x", "y"] and [r.link for r in E.since(e, "2023-01-15", 5).collect()] == ["z"]
    pages = spark.createDataFrame([("http://h/p/", '<link type="application/atom+xml" href="../f">')], "page string, html string")
    assert [tuple(r) for r in E.discovered(pages).collect()] == [("http://h/p/", "http://h/f")]
    tries = spark.createDataFrame([("u", 1, "a", "Access Denied", "x" * 600), ("u", 2, "b", "Fine", "y" * 600), ("v", 1, "a", "t", "short")], "url string, place int, route string, title string, body string")
    assert {tuple(r) for r in E.recovered(tries).collect()} == {("u", "b", True), ("v", "a", False)}


def test_workbooks(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="S" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>hé</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><f>1+1</f><v>2</v></c></row><row r="2"><c r="B2" t="b"><v>1</v></c></row></sheetData></worksheet>')
    (tmp_path / "bad.xlsx").write_bytes(b"no zip")
    cells = S.read_workbooks(spark, str(tmp_path))
    assert {tuple(r)[1:] for r in cells.collect()} == {("S", 1, 1, "string", "hé", None), ("S", 1, 3, "number", "2", "1+1"), ("S", 2, 2, "bool", "1", None), (None, 0, 0, "unreadable", None, None)}
    assert {tuple(r.cells) for r in S.sheet_rows(cells).collect()} == {("hé", None, "2"), (None, "1")}


def test_pdf_needs_a_library(spark, tmp_path):
    pytest.importorskip
    try:
        import pypdf  # noqa: F401
    except ImportError:
        with pytest.raises(RuntimeError):
            S.read_pdf_text(spark, str(tmp_path))


def test_streams_go_on_where_they_ended(spark, tmp_path):
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    schema = "id long, ts timestamp"
    day = [datetime(2024, 1, 1, h) for h in range(4)]
    for part in ([(1, day[0]), (1, day[0]), (2, day[1])], [(2, day[1]), (3, day[2])]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(folder)
        I.drained(I.first_only(I.arriving(spark, folder, spark.read.parquet(folder).schema), ["id"], "ts", "10 days"), out, state)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    assert I.newest(spark.read.parquet(out), "ts") == "2024-01-01 02:00:00"
    windows = I.windowed(spark.read.parquet(folder), "ts", "1 hour", "2 hours", ["id"])
    assert windows.count() == 3


def test_states_and_alerts(spark):
    s = spark.createDataFrame([("a", "PENDING", datetime(2024, 1, 1, 0)), ("a", "done ", datetime(2024, 1, 1, 1)), ("b", "pending", datetime(2024, 1, 1, 0)), ("c", "pending", datetime(2024, 1, 1, 0)), ("c", "pending", datetime(2024, 1, 1, 2))], "k string, s string, t timestamp")
    assert {tuple(r) for r in I.settled(s, "k", "s", "t", ["done"], 900).collect()} == {("a", "done"), ("b", "waiting"), ("c", "timeout")}
    a = spark.createDataFrame([("k", 1, "x"), ("k", 2, "x"), ("k", 3, "y"), ("k", 9000, "y")], "k string, t long, f string").withColumn("t", F.timestamp_seconds("t"))
    assert I.unsuppressed(a, "k", "t", "f", 3600).count() == 3
