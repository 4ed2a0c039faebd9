"""Core operators on small tables, with nulls, ties, repeats and empty inputs."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stemma.operators import audit as A
from stemma.operators import cited as C
from stemma.operators import filters as L
from stemma.operators import graph as G
from stemma.operators import joins as J
from stemma.operators import merge as M
from stemma.operators import ordered as O
from stemma.operators import quality as Q
from stemma.operators import resolve as R
from stemma.operators import workflow as W


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is not None, str(x)) for x in t))


def test_numbered_is_the_total_order(spark):
    values = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = {r.v: r.ordinal for r in O.numbered(df, ["v"], partitions=5).collect()}
    assert got == {v: i for i, v in enumerate(sorted(values), 1)}
    assert O.numbered(df.limit(0), ["v"]).count() == 0
    assert [r.id for r in O.surrogate_ids(df, ["v"]).orderBy("v").limit(2).collect()] == ["PUB-00001", "PUB-00002"]


def test_first_values_and_ordered_lists(spark):
    df = spark.createDataFrame([(1, 3, "c", None), (1, 1, " ", 2), (1, 2, "b", 1), (2, 1, None, None)], "k int, o int, v string, p int")
    got = {r.k: (r.f, list(r.l)) for r in df.groupBy("k").agg(O.first_value(F.col("v"), F.col("o")).alias("f"), O.ordered_list(F.col("o"), [F.col("p")], F.col("v").isNotNull()).alias("l")).collect()}
    assert got == {1: ("b", [2, 1, 3]), 2: (None, [])}


def test_kth_pairs_keep_leftovers(spark):
    a = spark.createDataFrame([(1, 10), (1, 11), (None, 12)], "k int, a int")
    b = spark.createDataFrame([(1, 20), (None, 21), (2, 22)], "k int, b int")
    got = {(r.k, r["l"].a if r["l"] else None, r["r"].b if r["r"] else None) for r in O.kth_pairs(a, b, ["k"], ["a"], ["b"]).collect()}
    assert got == {(1, 10, 20), (1, 11, None), (None, 12, 21), (2, None, 22)}


def test_lines(spark):
    text = "intro\n# A\nx-\n```\n[1] code\n```\ny\n# B\n[1] one\nmore\n[2] two hy-\nphen\n\nend"
    lines = O.lines_of(spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string"))
    assert [r.section for r in O.section_of(lines, F.col("line").startswith("#")).orderBy("line_no").collect()][:3] == [None, "# A", "# A"]
    assert "[1] code" not in {r.line for r in O.outside_fences(lines).collect()}
    tail = O.after_last_heading(lines, F.col("line").startswith("#"), F.trim("line") == "")
    assert [r.line for r in tail.orderBy("line_no").collect()] == ["[1] one", "more", "[2] two hy-", "phen"]
    items = O.joined_items(tail, F.col("line").rlike(r"^\[\d+\]"))
    assert {r.item for r in items.collect()} == {"[1] one more", "[2] two hyphen"}


def test_lookups_and_candidates(spark):
    people = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "z"), (4, None, "w")], "id int, name string, ref string")
    last = J.last_wins(people, "name", F.col("id"))
    assert {(r.name, r.id) for r in last.collect()} == {("a", 2), ("b", 3)}
    q = spark.createDataFrame([(1, "z", "a"), (2, "?", "a"), (3, None, None)], "q int, ref string, name string")
    got = {(r.q, r.found_id, r.found_by) for r in J.lookup_fallback(q, [("ref", people, "ref", "id"), ("name", last, "name", "id")]).collect()}
    assert got == {(1, 3, "ref"), (2, 2, "name"), (3, None, None)}
    assert rows(J.unique_candidate(q, "q", people, ["name"], "id")) == []
    assert rows(J.unique_candidate(spark.createDataFrame([(1, "b")], "q int, name string"), "q", people, ["name"], "id")) == [(1, 3)]


def test_groups_and_tiers(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 4, None), (1, 5, None), (2, 1, "a"), (2, 1, "a")], "g int, o int, k string")
    assert {(r.g, r.o) for r in J.other_in_group(df, "g", "o", "k").collect()} == {(1, 1), (1, 2)}
    d = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 1, "c")], "d int, g int, k string")
    o = spark.createDataFrame([(10, 1, "b"), (11, 1, "z")], "o int, g int, k string")
    assert rows(J.queue_tiers(d, o, "g", "d", "o", [["k"], []])) == [(1, 11, 2), (2, 10, 1)]
    t = J.tiered_match(spark.createDataFrame([(1, "x", None), (2, None, "n"), (3, None, None)], "q int, i string, n string"), "q", spark.createDataFrame([(7, "x", "n"), (6, "x", "m")], "t int, i string, n string"), "t", [("id", ["i"]), ("name", ["n"])])
    assert rows(t) == [(1, 6, "id"), (2, 7, "name"), (3, None, "missing")]


def test_null_safe_sets(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i int, k string")
    b = spark.createDataFrame([(1, None), (3, "y")], "i int, k string")
    assert rows(J.missing_keys(a, b, ["i", "k"])) == [(2, "x")]
    assert J.exists_null_safe(a, b, ["i", "k"]).count() == 2
    assert rows(Q.difference(a, b, ["i", "k"])) == [(2, "x", "missing"), (3, "y", "extra")]
    assert Q.difference(a, a, ["i", "k"]).count() == 0
    assert [(r.ok, r.n_bad) for r in Q.checked("c", J.missing_keys(a, b, ["i", "k"])).collect()] == [(False, 1)]


def test_boxes_sweeps_overlays_and_similar(spark):
    boxes = spark.createDataFrame([(1, 1, 0, 0, 2, 2), (1, 2, 1, 1, 3, 3), (1, 3, 2, 2, 4, 4), (2, 1, 0, 0, 9, 9)], "page int, n int, x0 int, y0 int, x1 int, y1 int")
    assert rows(J.box_overlaps(boxes, "page", "n")) == [(1, 1, 2), (1, 2, 3)]
    one = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    assert J.sweep(one(1, 2), one(1, 2, 3).withColumnRenamed("v", "w")).count() == 6
    slots = spark.createDataFrame([("a", 1, "f", False), ("b", None, "g", False), ("c", 2, "h", True)], "name string, node int, field string, is_link boolean")
    values = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("z", "4")], "name string, v string")
    assert {(r.name, r.status) for r in J.overlay(values, slots, "name", "v").collect()} == {("a", "set"), ("b", "missing_node"), ("c", "link"), ("z", "unknown")}
    t = spark.createDataFrame([(1, "k", "wear of weirs"), (2, "k", "wear of weir"), (3, "k", None), (4, "j", "wear of weirs")], "i int, b string, t string")
    u = t.select(F.col("i").alias("i2"), "b", F.col("t").alias("t2"))
    assert {(r.i, r.i2) for r in J.similar_pairs(t, u, ["b"], "t", "t2", 0.85, F.col("i") < F.col("i2")).collect()} == {(1, 2)}


def test_ranked_merge_is_the_fold(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(1, 6), i, rnd.randint(0, 3), rnd.choice([None, "", f"a{i}"]), rnd.choice([None, f"b{i}"])) for i in range(60)]
    df = spark.createDataFrame(data, "k int, o int, r int, a string, b string")
    want = {}
    for k, _, r, a, b in data:
        new = {"r": r, "a": a or None, "b": b or None}
        old = want.get(k)
        if old is None:
            want[k] = new
        else:
            base, fill = (new, old) if r > old["r"] else (old, new)
            want[k] = {"r": max(r, old["r"]), "a": base["a"] or fill["a"], "b": base["b"] or fill["b"]}
    got = {r.k: {"r": r["rank"], "a": r.a, "b": r.b} for r in M.merge_ranked(df, ["k"], F.col("o"), F.col("r"), ["a", "b"]).collect()}
    assert got == want


def test_identity_and_upsert(spark, tmp_path):
    df = spark.createDataFrame([(1, "10.5555/A.", "T", 2000), (2, None, "It's", 2000), (3, None, "Its", None), (4, None, None, None)], "i int, d string, t string, y int")
    assert [r.k.kind for r in df.select("i", M.identity_key(F.col("d"), F.col("t"), F.col("y"), F.col("i")).alias("k")).orderBy("i").collect()] == ["doi", "title_year", "title", "record"]
    a = spark.createDataFrame([("x", None, "1", None), ("x", 1, "2", "q"), ("z", 1, None, None)], "k string, y int, v string, w string")
    b = spark.createDataFrame([("x", None, "9", "new"), ("n", None, "5", None)], "k string, y int, v string, w string")
    assert rows(M.upsert(a, b, ["k", "y"])) == rows(spark.createDataFrame([("n", None, "5", None, "inserted"), ("x", None, "1", "new", "updated"), ("x", 1, "2", "q", "kept"), ("z", 1, None, None, "kept")], "k string, y int, v string, w string, change string"))
    assert {r.v for r in M.upsert(a, b, ["k", "y"], ["v"]).where("change = 'updated'").collect()} == {"9"}
    assert M.doubled(a, ["k"]).count() == 1
    path = f"file://{tmp_path}/t"
    M.replace_table(a, path)
    M.replace_table(M.upsert(spark.read.parquet(path), b, ["k", "y"]).drop("change"), path)
    assert spark.read.parquet(path).count() == 4


def test_profiles(spark):
    df = spark.createDataFrame([("a", [1], None), (" ", [], 1), (None, None, 2)], "s string, l array<int>, n int")
    assert rows(Q.completeness(df)) == [("l", 1, 2, 33.3), ("n", 2, 1, 66.7), ("s", 1, 2, 33.3)]
    assert [r.percent for r in Q.completeness(df.limit(0)).collect()] == [0.0] * 3
    assert {r.x for r in df.select(Q.first_reason([("n", F.col("n").isNull()), ("s", F.col("s").isNull())], "ok").alias("x")).collect()} == {"n", "ok", "s"}
    rules = [("n", F.col("n").isNull()), ("s", F.coalesce(F.trim("s") == "", F.lit(True)))]
    assert sorted(list(r.x) for r in df.select(Q.warnings(rules).alias("x")).collect()) == [["n"], ["s"], ["s"]]
    before, after = Q.table_counts({"a": df, "b": df}), Q.table_counts({"a": df, "b": df.limit(1)})
    assert rows(Q.changed_counts(before, after)) == [("b", 3, 1)]
    seen = spark.createDataFrame([(1, " DONE "), (2, "odd")], "k int, s string")
    assert rows(Q.inventory(spark.createDataFrame([(1,), (2,), (3,)], "k int"), seen, "k", "s", {"processed": ["done"]})) == [(1, "processed"), (2, "unknown"), (3, "missing")]


def test_pointers(spark):
    edges = [(i, i - 1 if i > 1 else None) for i in range(1, 40)] + [(50, 51), (51, 52), (52, 50), (60, 61), (70, 60), (80, 80)]
    df = spark.createDataFrame(edges, "n int, p int")
    got = {r.n: (r.root, r.status) for r in G.chase(df, "n", "p").collect()}
    assert got[1] == (1, "root") and all(got[i] == (1, "found") for i in range(2, 40))
    assert {got[i] for i in (50, 51, 52, 80)} == {(None, "cycle")} and {got[60], got[70]} == {(None, "missing")}
    near = {r.n: r.reached for r in G.chase_bounded(df, "n", "p", 5).collect()}
    assert near[6] and not near[7] and not near[50] and not near[60] and near[1]
    one = G.single_root(G.chase(df, "n", "p"), spark.createDataFrame([(2, "s"), (3, "s"), (50, "t")], "n int, s string"), "n", "s")
    assert rows(one) == [("s", 1, False)]
    assert G.chase(df.limit(0), "n", "p").count() == 0


def test_trees_and_names(spark):
    df = spark.createDataFrame([(1, None, "b"), (2, 1, "z"), (3, 1, "a"), (4, None, "a"), (5, 3, "q"), (6, 99, "c"), (7, 8, "x"), (8, 7, "y")], "n int, p int, l string")
    got = [(r.n, r.depth) for r in G.tree(df, "n", "p", "l").orderBy("place").collect()]
    assert got == [(4, 0), (1, 0), (3, 1), (5, 2), (2, 1), (6, 0)]
    assert {r.unique_name for r in G.unique_names(df.select("n", F.lit("k").alias("l")).limit(2), "l", "n").collect()} == {"k_1", "k_2"}
    links = spark.createDataFrame([("a", "b", "pass"), ("b", "c", "pass"), ("c", "d", "end"), ("x", "y", "pass"), ("y", "x", "pass")], "node string, source string, kind string")
    t = {r.start: (r.target, r.hops) for r in G.traced(links, spark.createDataFrame([("a",), ("x",)], "start string"), F.col("kind") == "pass").collect()}
    assert t["a"] == ("d", 3) and t["x"][1] == 8


def test_tree_deeper_than_64_levels(spark):
    df = spark.createDataFrame([(n, n - 1 if n else None, "x") for n in range(67)], "n int, p int, l string")
    got = [(r.n, r.depth) for r in G.tree(df, "n", "p", "l").select("n", "depth").collect()]
    assert sorted(got) == [(n, n) for n in range(67)]


def test_wiki(spark):
    pages = spark.createDataFrame([("A", "[[B]] [[Z]]", datetime(2024, 1, 1)), ("B", "x\n" * 300, datetime(2020, 1, 1))], "page string, text string, updated timestamp")
    assert {(r.page, r.issue) for r in G.wiki_report(pages, "2023-01-01").collect()} == {("A", "broken_link"), ("A", "orphan"), ("B", "stale"), ("B", "long")}


def test_hash_chain(spark):
    events = spark.createDataFrame([("l", i, f"e{i}") for i in range(5)], "log string, n int, p string")
    log = A.chained(events, ["log"], "n", F.col("p")).cache()
    assert A.verified(log, ["log"], "n").where("not (link_ok and hash_ok)").count() == 0
    forged = log.withColumn("payload", F.when(F.col("n") == 2, "forged").otherwise(F.col("payload")))
    assert [r.n for r in A.verified(forged, ["log"], "n").where("not hash_ok").collect()] == [2]
    assert [r.n for r in A.verified(log.where("n <> 2"), ["log"], "n").where("not link_ok").collect()] == [3]
    broken = log.unionByName(log.where("n = 1").select("log", F.lit(9).alias("n"), F.lit(None).cast("string").alias("payload"), F.lit(None).cast("string").alias("previous_hash"), F.lit(None).cast("string").alias("event_hash")))
    assert [r.n for r in A.verified(broken, ["log"], "n").where("not link_ok").collect()] == [9]


def test_ladder_and_decisions(spark):
    pairs = spark.createDataFrame([("ann lee", "ann lee"), ("ann m lee", "ann lee"), ("a lee", "ann lee"), ("ann mary leee", "ann mary lee"), ("bob ray", "ann lee"), (None, "x")], "a string, p string")
    assert [r.rung for r in R.name_ladder(pairs, "a", "p").orderBy(F.asc_nulls_last("a")).collect()] == ["FIRST_INITIAL", "EXACT", "FIRST_LAST", "HIGH_SIMILARITY", "MISMATCH", "MISMATCH"]
    roster = spark.createDataFrame([(1, "ann lee"), (2, "bob ray"), (3, "cy ray")], "person_id int, name string")
    occ = [(1, 1, 1, "ann lee"), (2, 2, 1, "bob ray"), (3, 2, 2, "ann lee"), (4, 3, 9, "zed"), (5, 3, None, "bob q ray"), (6, 3, None, "dr x"), (7, 4, 1, "zed ooo")]
    o = spark.createDataFrame(occ, "occurrence_id int, publication_id int, person_ref int, name string")
    over = spark.createDataFrame([("dr x", 3)], "name string, person_id int")
    got = {r.occurrence_id: (r.person_id, r.classification) for r in R.resolved(o, roster, over).collect()}
    assert got == {1: (1, "EXACT"), 2: (None, "ID_SWAP"), 3: (None, "ID_SWAP"), 4: (None, "UNKNOWN_REFERENCE"), 5: (2, "UNIQUE_NAME"), 6: (3, "OVERRIDE"), 7: (None, "MISMATCH")}
    assert R.resolved(o.limit(0), roster).count() == 0


def test_citations(spark):
    drafts = spark.createDataFrame([(1, "One two three four [1]. Five six seven eight.\n```\n[9] in code\n```\n# Head [3]")], "doc_id int, text string")
    assert rows(C.coverage(drafts)) == [(1, 2, 1)]
    listed = spark.createDataFrame([(1, 1, "http://a/"), (1, 2, "http://x")], "doc_id int, source_id int, url string")
    ledger = spark.createDataFrame([(1, "http://a#f"), (2, "http://b")], "source_id int, url string")
    assert {(r.source_id, r.issue) for r in C.citation_check(drafts, listed, ledger).collect()} == {(9, "unknown"), (3, "unknown"), (2, "uncited")}


def test_workflows(spark):
    graph = '{"1":{"class_type":"Loader","inputs":{"file":"models/a.safetensors","n":3}},"2":{"class_type":"Text","inputs":{"text":"embedding:e1, embedding:e1","from":["1",0]}},"x":{"foo":1}}'
    n = W.nodes(spark.createDataFrame([(1, graph), (2, "not json")], "workflow_id int, graph string"))
    i = W.inputs(n)
    assert n.count() == 2 and [(r.node, r.link_to) for r in i.where("link_to is not null").collect()] == [("2", "1")]
    assert [r.name for r in W.embedding_refs(i).collect()] == ["e1"]
    needs = W.model_needs(i, spark.createDataFrame([("Loader", "file", "m")], "class_type string, field string, folder string"))
    have = W.listed_models(spark.createDataFrame([("m", '["A.ckpt", {"name": "b"}]')], "folder string, models string"))
    assert {r.model for r in have.collect()} == {"A.ckpt", "b"} and W.missing_models(needs, have).count() == 0
    assert [r.class_type for r in W.missing_classes(n, spark.createDataFrame([("Text",)], "class_type string")).collect()] == ["Loader"]
    assert [r.n_files for r in W.output_files(spark.createDataFrame([(1, '{"a":["x","y"],"b":["z"]}'), (2, None)], "run_id int, outputs string")).orderBy("run_id").collect()] == [3, 0]


def test_filters(spark):
    df = spark.createDataFrame([(1, "a", None, {"k": "v", "z": "w"}, [1, 2], [2, 3])], "i int, a string, b string, m map<string,string>, x array<int>, y array<int>")
    assert df.where(L.all_of([F.col("i") == 1, None])).count() == 1 == df.where(L.all_of([])).count()
    cols, rest = L.promoted(F.col("m"), ["k", "q"])
    r = df.select(L.assembled("a", "b").alias("n"), *cols, rest.alias("rest"), L.ordered_union(F.col("x"), F.col("y")).alias("u")).first()
    assert (r.n, r.k, r.q, dict(r.rest), list(r.u)) == ("a", "v", None, {"z": "w"}, [1, 2, 3])
