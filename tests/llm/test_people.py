"""Names (5) and matching by belief propagation (3)."""

import itertools
import math
import random
import time
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stemma.llm import matching as M
from stemma.llm import names as N
from stemma.llm import people as P
from stemma.llm import trie_join as J
from stemma.session import Scratch, shared_dir


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=9), st.lists(st.text("abc", min_size=1, max_size=9), max_size=12), st.sampled_from([1, 2]))
def test_automaton_finds_what_the_table_says(word, entries, most):
    got = dict(J.near(word, J.trie(entries), most))
    assert got == {w: N.edits(word, w, most) for w in entries if N.edits(word, w, most) <= most}


def test_near_words_against_brute_force(spark):
    random.seed(3)
    w = ["".join(random.choice("ab") for _ in range(random.randint(1, 9))) for _ in range(150)]
    df = spark.createDataFrame([(x,) for x in w] + [(None,), ("",)], "word string")
    for limit in (20_000, 3):  # the second cuts every shard to pieces
        got = {(r.probe, r.word): r.distance for r in J.near_words(df, df, 1, limit).collect()}
        want = {(a, b): N.edits(a, b, 1) for a in set(w) for b in set(w) if a == b or len(a) > 2 and len(b) > 2 and N.edits(a, b, 1) == 1}
        assert got == want
    assert J.near_words(df.limit(0), df).count() == 0


def test_one_edit_without_tries_against_brute_force(spark):
    random.seed(12)
    w = {"".join(random.choice("aab\u00e9") for _ in range(random.randint(1, 6))) for _ in range(150)} | {"xaby", "xbcy", "xbay", "\U0001d49cbc", "b\U0001d49cc"}
    for n in (J.LONG_WORD - 1, J.LONG_WORD, J.LONG_WORD + 1):  # on both sides of the border to the tries
        x = "".join(random.choice("abcdef") for _ in range(n))
        w |= {x, x + "k", "k" + x, x[1:], x[:9] + x[10] + x[9] + x[11:], x[:-2] + "k" + x[-1]}
    df = spark.createDataFrame([(x,) for x in w], "word string")
    near = lambda rows: sorted((a, b, N.edits(a, b, 1)) for a in rows for b in rows if a == b or min(len(a), len(b)) > 2 and N.edits(a, b, 1) == 1)
    assert sorted(tuple(r) for r in J.near_words(df, df, 1).select("probe", "word", "distance").collect()) == near(w)
    short = df.where(f"length(word) <= {J.LONG_WORD}")
    got = J._one_edit(short, short.withColumnRenamed("word", "entry"))
    assert sorted({tuple(r) for r in got.collect()}) == near({x for x in w if len(x) <= J.LONG_WORD})
    assert "FlatMapCoGroups" not in got._jdf.queryExecution().toString()


def test_near_words_within_two_edits_against_brute_force(spark):
    random.seed(4)
    w = ["".join(random.choice("ab") for _ in range(random.randint(4, 11))) for _ in range(80)]
    for _ in range(150):  # long words with an edit, or a swap, anywhere
        x = "".join(random.choice("abcdefghij") for _ in range(random.randint(7, 14)))
        y = x
        for _ in range(2):
            i = random.randrange(len(y) - 1)
            y = random.choice([y[:i] + y[i + 1 :], y[:i] + "k" + y[i:], y[:i] + "k" + y[i + 1 :], y[:i] + y[i + 1] + y[i] + y[i + 2 :], y + "k"])
        w += [x, y]
    df = spark.createDataFrame([(x,) for x in w], "word string")
    want = {(a, b): d for a in set(w) for b in set(w) for d in [N.edits(a, b, 2)] if d == 0 or len(b) > 2 and d <= (0 if len(a) < 3 else 1 if len(a) < 7 else 2)}
    for limit in (20_000, 3):
        got = {(r.probe, r.word): r.distance for r in J.near_words(df, df, 2, limit).collect()}
        assert got == want


def test_near_words_by_group_against_brute_force(spark):
    random.seed(6)
    w = [("".join(random.choice("ab") for _ in range(random.randint(1, 9))), random.choice(["x", "y", ">", None])) for _ in range(200)]
    df = spark.createDataFrame(w, "word string, place string")
    ok = lambda a, b: a == b or min(len(a), len(b)) > 2 and N.edits(a, b, 2) <= (1 if len(a) < 7 else 2)
    want = sorted((g, a, b, N.edits(a, b, 2)) for a, g in set(w) for b, h in set(w) if g and g == h and ok(a, b))
    for limit in (20_000, 3):
        assert sorted((r.place, r.probe, r.word, r.distance) for r in J.near_words(df, df, 2, limit, by="place").collect()) == want


def test_near_words_in_both_halves_and_short(spark):
    pairs = [("bernhardsen", "barnhardson"), ("kowalskii", "cowalski"), ("villanueva", "vilanueba"), ("wang", "wamg"), ("cruz", "crux"), ("kim", "kin"), ("lee", "le"), ("ng", "nh")]
    a = spark.createDataFrame([(x,) for x, _ in pairs], "word string")
    b = spark.createDataFrame([(y,) for _, y in pairs], "word string")
    assert {(r.probe, r.word) for r in J.near_words(a, b, 2).collect()} == set(pairs[:6])


@pytest.mark.parametrize("other", ["Ann Marie Stoneham", "Stoneham, Ann M.", "A. M. Stoneham", "STONEHAM Ann", "Stoneham AM", "Dr. Ann Stoneham, PhD", "ann stoneham", "Ann Stonehma", "Stoneham, A.", "Ann Stonham", "Αnn Stoneham"])
def test_spellings_of_one_name(other):
    assert N.name_score(other, "Ann Marie Stoneham") >= 0.69


@pytest.mark.parametrize("other", ["Bob Stoneham", "Ann Marie Fielder", "B. Stoneham", "Ann Paula Stoneham", "", None])
def test_other_names(other):
    assert N.name_score(other, "Ann Marie Stoneham") < 0.5


def test_short_forms_particles_and_double_names():
    assert N.name_score("Bill van Marsh", "William van Marsh") > 0.9
    assert N.name_score("de la Marsh, W.", "William de la Marsh") > 0.7
    assert N.name_score("William Marsham", "William Marsham-Fieldes") > 0.8
    assert N.name_score("J.R. Marsham", "Judith Ruth Marsham") > 0.7


@pytest.mark.parametrize(
    "a,b,m",
    [
        ("University of Dale", "The University of Dale, Dale", 1.0), ("Dale Inst. of Tech.", "DALE INSTITUTE OF TECHNOLOGY (DIT)", 1.0), ("Dept. of Physics, Univ. of Dalewick", "University of Dalewick", 1.0),
        ("University of Dalewick", "University of Dalewcik", 0.8), ("University of Dale", "Dale Polytechnic", 0.0), ("University of Dale", "University of Wick", 0.0), (None, "University of Dale", 0.5), (" ", None, 0.5),
        ("Université de Dale", "Universite Dale", 1.0), ("TH Dale", "Technische Hochschule Dale", 1.0), ("Dale State Univ.", "Dale State University", 1.0),
    ],
)
def test_institutions(a, b, m):
    assert N.institution_match(a, b) == m == N.institution_match(b, a)


PROFESSOR = "professor_id long, full_name string, first_name string, middle_name string, last_name string, institution string, department_id int, orcid string, semantic_scholar_id string, d_place string"


def _professors(spark):
    rows = [
        (1, "Ann Marie Stoneham", "Ann", "Marie", "Stoneham", "University of Dale", None, "0099-1111-2222-3333", None, "clash"),
        (2, "Stoneham, Ann", None, None, "Stonehamm", "Univ. of Dale", None, None, None, "clash"),
        (3, "Ann Stoneham", "Ann", None, "Stoneham", "Wick Polytechnic", None, "n/a", "70000000001", "clash"),
        (4, "Piotr Fielder", "Fielder", None, "Piotr", None, 9, None, "S2:70000000002", "clash"),
        (5, "", None, None, None, None, None, None, None, "clash"),
    ]
    return spark.createDataFrame(rows + rows[:1], PROFESSOR)


def test_author_links(spark):
    departments = spark.createDataFrame([(9, "Moor College of Engineering")], "department_id int, institution string")
    rows = [
        (1, None, "A. M. Stonehma", "University of Dale"), (1, None, "A. M. Stonehma", "University of Dale"), (2, None, "Stoneham, A.", "Wick Poly."), (3, None, "Ann Stoneham", "Moor Polytechnic"), (4, None, "FIELDER Piotr", None),
        (5, None, None, None), (6, None, "", "University of Dale"), (7, 3, "Ann Stoneham", "Wick Polytechnic"), (8, None, "Ann Stoneham", None),
    ]
    a = spark.createDataFrame(rows, "authorship_id long, professor_id long, author_name_as_published string, institution string")
    got = {tuple(r) for r in P.author_links(_professors(spark), departments, a).collect()}
    assert got == {("professor", 1, 2), ("authorship", 1, 1), ("authorship", 1, 2), ("authorship", 2, 3), ("authorship", 4, 4)}
    assert P.author_links(_professors(spark).limit(0), departments, a).count() == 0


def test_author_links_two_edits_apart_at_one_place(spark):
    rows = [(1, "Farah di Walanński", "Farah", None, "di Walanński", "Tamolar Polytechnic", None, None, None, None)]
    authors = [(1, None, "DIWALANŃSKI, Farah", "Tamolar Polytechnic"), (2, None, "DIWALANŃSKI, Farah", None), (3, None, "DIWALANŃSKI, Farah", "Moor Polytechnic")]
    a = spark.createDataFrame(authors, "authorship_id long, professor_id long, author_name_as_published string, institution string")
    assert {tuple(r) for r in P.author_links(spark.createDataFrame(rows, PROFESSOR), None, a).collect()} == {("authorship", 1, 1)}


def test_short_family_names_need_a_full_given_name_at_one_place(spark):
    rows = [(1, "Mei Wang", "Mei", None, "Wang", "Tamolar Polytechnic", None, None, None, None)]
    authors = [(1, None, "Wamg, Mei", "Tamolar Polytechnic"), (2, None, "Wamg, M.", "Tamolar Polytechnic"), (3, None, "Wamg, Mei", None), (4, None, "Wang, M.", "Tamolar Polytechnic")]
    a = spark.createDataFrame(authors, "authorship_id long, professor_id long, author_name_as_published string, institution string")
    assert {tuple(r) for r in P.author_links(spark.createDataFrame(rows, PROFESSOR), None, a).collect()} == {("authorship", 1, 1), ("authorship", 4, 1)}


def _shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for k in range(files.size()) if (f := files.apply(k).getName()).startswith("shuffle_")}


def test_links_leave_no_shuffle_files_and_drop_their_tables(spark):
    a = spark.createDataFrame([(1, None, "A. M. Stonehma", "University of Dale"), (2, None, "FIELDER Piotr", None)], "authorship_id long, professor_id long, author_name_as_published string, institution string")
    shared = Path(shared_dir(spark).removeprefix("file://"))
    files, tables = _shuffled(spark), set(shared.iterdir())
    got = P.author_links(_professors(spark), None, a)
    until = time.time() + 20  # they are deleted by other threads
    while _shuffled(spark) - files and time.time() < until:
        time.sleep(0.2)
    assert not _shuffled(spark) - files
    assert len(set(shared.iterdir()) - tables) == 1 and got.count() > 2


def test_names_meet_in_rounds_as_at_once(spark, monkeypatch):
    random.seed(14)
    w = ["".join(random.choice("abc") for _ in range(random.randint(1, 7))) for _ in range(120)] + ["x" * J.LONG_WORD, "x" * J.LONG_WORD + "y"]
    df = spark.createDataFrame([(x,) for x in w], "word string")
    shares = [{tuple(r) for r in J.near_words(df, df, 1, part=(k, 3)).collect()} for k in range(3)]
    assert all(shares) and set().union(*shares) == {tuple(r) for r in J.near_words(df, df, 1).collect()}
    firsts, families = ["Bob", "Robert", "Rbert", "R.", "Ann"], ["Stoneham", "Stonehma", "Li", "Marsham"]
    rows = [(i, None, f"{random.choice(firsts)} {random.choice(families)}", random.choice(["University of Dale", None])) for i in range(40)]
    a = spark.createDataFrame(rows, "authorship_id long, professor_id long, author_name_as_published string, institution string")
    whole = {tuple(r) for r in P.author_links(_professors(spark), None, a).collect()}
    monkeypatch.setattr(P, "KEYS_A_ROUND", 9)
    assert {tuple(r) for r in P.author_links(_professors(spark), None, a).collect()} == whole and len(whole) > 3


def test_candidates_against_all_pairs_and_a_hot_family_name(spark):
    """Blocks lose no pair that the comparison of all pairs accepts, and a common family name is not multiplied out."""
    random.seed(5)
    firsts, families, places = ["Bob", "Robert", "Rbert", "R.", "Ann", "Anna", "Hana", "Nan", "A."], ["Stoneham", "Stonehma", "Li", "Lin", "Marsham"], ["University of Dale", "Univ. of Dale", "Dale Polytechnic", None, "University of Dael"]
    make = lambda: (random.choice(["{g} {f}", "{f}, {g}", "{f} {g}"]).format(g=random.choice(firsts), f=random.choice(families)), random.choice(places))
    professors = [(i, *make()) for i in range(60)]
    authors = [(i, *make()) for i in range(120)]
    p = spark.createDataFrame([(i, n, None, None, None, w, None, None, None, None) for i, n, w in professors], PROFESSOR)
    a = spark.createDataFrame([(i, None, n, w) for i, n, w in authors], "authorship_id long, professor_id long, author_name_as_published string, institution string")
    with Scratch(spark) as tables:
        parts = ["id", "name_id", "name", "other", "at"]
        people = P.roster(p, None).withColumn("id", F.col("professor_id")).withColumn("name_id", P.name_id(F.col("name"), F.col("other"))).select(parts)
        own = P.with_place(a.select(F.col("authorship_id").alias("id"), F.col("author_name_as_published").alias("name"), F.lit(None).cast("string").alias("other"), F.col("institution").alias("place"))).withColumn("name_id", P.name_id(F.col("name"), F.col("other"))).select(parts)
        met = P.Meeting(tables, own, people, tables.written(P.spelled(P.names_of(own.unionByName(people)), P.given_words(p)), "keys"))
        placed = {(r.id_a, r.id_b) for r in met.at_place().collect()}
        text_a, text_b = {r.name_id: r.name for r in own.collect()}, {r.name_id: r.name for r in people.collect()}
        whole = [(text_a[r.name_a], text_b[r.name_b]) for r in met.anywhere().collect()]
    assert len(whole) == len(set(whole))
    for i, n, w in authors:
        for j, m, v in professors:
            score, place = N.name_score(n, m), N.institution_match(w, v)
            if place > 0.5 and score >= P.SAME_PLACE:
                assert (i, j) in placed, (n, m, w, v)
            if place == 0.5 and score >= P.NO_PLACE:
                assert (n, m) in whole, (n, m)
    hot = [(n, m) for n, m in whole if "Stoneham" in n and "Stoneham" in m]
    assert all(N.name_score(n, m) > 0 for n, m in hot)


def _exact(pairs, rho):
    """Marginals by adding up all subsets of the pairs."""
    total, own = 0.0, [0.0] * len(pairs)
    for chosen in itertools.product([0, 1], repeat=len(pairs)):
        w, da, db = 1.0, {}, {}
        for x, (a, b, prior) in zip(chosen, pairs):
            if x:
                w *= math.exp(prior)
                da[a], db[b] = da.get(a, 0) + 1, db.get(b, 0) + 1
        for n in [*da.values(), *db.values()]:
            w *= rho ** max(0, n - 1)
        total += w
        for i, x in enumerate(chosen):
            own[i] += w * x
    return [o / total for o in own]


def test_marginals_on_trees_are_exact(spark):
    pairs = [(1, 1, 2.0), (1, 2, 1.0), (2, 2, 0.5), (3, 2, -1.0), (9, 9, 0.3), (4, 7, 3.0), (4, 8, 3.0)]
    got = {(r.a, r.b): r.confidence for r in M.marginals(spark.createDataFrame(pairs, "a long, b long, prior double"), rounds=30, tolerance=1e-6).collect()}
    for (a, b, _), want in zip(pairs, _exact(pairs, M.RHO)):
        assert got[a, b] == pytest.approx(want, abs=1e-3)


def test_marginals_with_a_loop_settle(spark):
    pairs = [(1, 1, 2.0), (1, 2, 1.0), (2, 2, 1.5), (2, 1, 0.2)]
    got = {(r.a, r.b): r.confidence for r in M.marginals(spark.createDataFrame(pairs, "a long, b long, prior double")).collect()}
    for (a, b, _), want in zip(pairs, _exact(pairs, M.RHO)):
        assert got[a, b] == pytest.approx(want, abs=0.1)
    with pytest.raises(M.Unsettled):
        M.marginals(spark.createDataFrame(pairs, "a long, b long, prior double"), rounds=2, tolerance=1e-9)


def test_matches(spark):
    rows = [
        (1, "Stoneham, Ann M.", None, None, "University of Dale"), (2, "Ann Stoneham", None, "70000000001", None), (3, "Ann Stoneham", "0099-9999-9999-9999", None, "Moor Polytechnic"), (4, "Ann Marie Fielder", "0099111122223333", None, "University of Dale"),
        (5, "Zed Other", "0099-1111-2222-3333", None, "Moor Polytechnic"), (6, None, None, None, None),
    ]
    profiles = spark.createDataFrame(rows + rows[:1], "profile_id long, display_name string, orcid string, scholar_ref string, affiliation string")
    got = {(r.professor_id, r.profile_id) for r in M.matches(_professors(spark), None, profiles).collect() if r.confidence > M.MATCH}
    assert got == {(1, 1), (2, 1), (3, 2), (1, 4)}
    assert M.matches(_professors(spark), None, profiles.limit(0)).count() == 0


def test_identifiers(spark):
    from pyspark.sql import functions as F

    rows = [("https://orcid.example/0099-1111-2222-333X",), ("0099 1111 2222 333x",), ("ORCID: 0099–1111–2222–333X",), ("0000-0000-0000-0000",), ("pending",), ("",), (None,)]
    got = [r.x for r in spark.createDataFrame(rows, "c string").select(P.digits(F.col("c"), 16).alias("x")).collect()]
    assert got == ["009911112222333X"] * 3 + [None] * 4
    rows = [("S2:70123456789",), ("https://scholar-index.example/author/70123456789",), ("70123456789.0",), (" 70123456789",)]
    assert {r.x for r in spark.createDataFrame(rows, "c string").select(P.digits(F.col("c"), 11).alias("x")).collect()} == {"70123456789"}
