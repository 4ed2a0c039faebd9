"""Text forms (2), copies (1) and survivors (6)."""

import itertools
import random
import unicodedata
from collections import defaultdict
from datetime import datetime

import numpy as np
import pytest

from stemma.llm import copies as C
from stemma.llm import text_forms as T


@pytest.mark.parametrize(
    "text,shown",
    [
        (None, None), ("", ""), ("plain", "plain"), ("Cаvitаtion", "Cavitation"), ("ｌoad　forecasting", "load forecasting"), ("rob​ot", "robot"), ("ﬁlm", "film"),
        ("café", "café"), ("a b", "a b"), ("Вајо Suelos", "Bajo Suelos"), ("fοr weirs", "for weirs"), ("soft­hyphen", "softhyphen"),
    ],
)
def test_imitations_are_undone(text, shown):
    assert T.reader_form(text) == shown
    assert T.imitates(text) == (text != shown)


@pytest.mark.parametrize("text", ["δ-phase films", "Δ-phase", "5 Å resolution", "О моделях коррозии датчиков MEMS — Jorelton", "“quoted” – dash…", "naïve", "大潮条件下 — Pelavale", "研究：方法，一", "tab\there\n  two", "l’usure", "m² and ½"])
def test_what_stands_for_itself_is_left_alone(text):
    assert T.reader_form(text) == text and not T.imitates(text)


def test_russian_text_with_a_latin_letter():
    assert T.reader_form("Устойчивый aнaлиз усталости") == "Устойчивый анализ усталости"


def test_names_have_no_symbols():
    assert T.reader_form("ν. Marsh", symbols=False) == "v. Marsh" and T.reader_form("ν ratio") == "ν ratio"


def test_long_text_and_idempotence():
    s = "Cаvitаtion οf weirs " * 20_000
    once = T.reader_form(s)
    assert once == "Cavitation of weirs " * 20_000 and T.reader_form(once) == once


def test_skeleton_is_decomposed():
    assert T.skeleton("café") == unicodedata.normalize("NFD", "café") == T.skeleton("café")


@pytest.mark.parametrize(
    "title,year,key",
    [
        ("A title!", 2001, ("atitle", 2001)), ("2015|A title", None, ("atitle", 2015)), ("(2015) A title", None, ("atitle", 2015)), ("A title / 2015", None, ("atitle", 2015)), ("A title, 2015", None, ("atitle", 2015)),
        ("A title (2015)", None, ("atitle", 2015)), ("2015. A title", None, ("atitle", 2015)), ("2015 - A title", None, ("atitle", 2015)), ("2015\tA title", None, ("atitle", 2015)), ("since the 1998 season", None, ("sincethe1998season", None)),
        ("2015|A title", 2015, ("2015atitle", 2015)), ("GROẞE Hitze", 1, ("grossehitze", 1)), ("", 3, (None, 3)), (None, 3, (None, 3)), ("?!", None, (None, None)),
    ],
)
def test_canonical(title, year, key):
    assert C.canonical(title, year) == key


@pytest.mark.parametrize(
    "text,shown",
    [
        ("We\u13aar of weirs", "WeAr of weirs"), ("C\u13a1eep", "CReep"), ("mode\u217c", "model"), ("\u216fodel wear", "Model wear"), ("te\u1d00r", "tear"), ("c\u0196ay", "clay"), ("\u2102reep", "Creep"), ("\U000102a0ge of weirs", "Age of weirs"),
        ("Wear \u13a9\u13aa", "Wear YA"), ("\u13a0\u13b9 \u13a9\u13aa", "\u13a0\u13b9 \u13a9\u13aa"), ("in \u2102 and \u2163", "in \u2102 and \u2163"), ("\u0131lg\u0131n \u00fe\u00f3r \u0142ad \u0140l", "\u0131lg\u0131n \u00fe\u00f3r \u0142ad \u0140l"), ("AI\u4e28\u5de5", "AI\u4e28\u5de5"),
    ],
)
def test_look_alikes_of_all_scripts(text, shown):
    assert T.reader_form(text) == shown


def test_the_confusables_data_are_whole():
    assert len(T.confusables()) > 6000 and T.confusables()["\u0430"] == "a" and T.confusables()["\u13aa"] == "A"
    assert 300 < len(T.lookalikes()) and not any(c.isascii() for c in T.lookalikes())


def test_merged_filters_never_lose_a_repeat():
    rng = np.random.default_rng(5)
    h = rng.integers(-(2**63), 2**63 - 1, 4000)
    h = np.concatenate([h, h[:300], h[:50]])
    rng.shuffle(h)
    import pyarrow as pa

    parts = [list(C._partition_filters(1 << 16)(iter([pa.RecordBatch.from_arrays([pa.array(x)], ["h"])]))) for x in np.array_split(h, 7)]
    words = np.zeros((1 << 16) // 64, np.uint64)
    chunk = pa.array([0], pa.int32())[0]
    for b in C._merge_chunk((chunk,), iter([x for p in parts for x in p])):
        words[:] = C._unpacked(b.column(1)[0].as_py())
    v, n = np.unique(h, return_counts=True)
    got = C._have(words, C._places(v.view(np.uint64), 1 << 16))
    assert got[n > 1].all() and got[n == 1].mean() < 0.02


def _papers(spark, rows):
    return spark.createDataFrame(rows, "paper_id long, title string, publication_year int, doi string, abstract string, metadata_status string, source_name string, updated_at timestamp, group_id string, k string")


def _paper(i, title, year, doi=None, abstract=None, status="DISCOVERED", source=None, day=1):
    return (i, title, year, doi, abstract, status, source, datetime(2024, 1, day), "clash", "clash")


def test_groups_against_brute_force(spark):
    random.seed(7)
    base = ["Wear of weirs", "wear OF  weirs.", "Weаr of weirs", "Wear of weir", "Creep", "CREEP!", "Großer Creep", "", None, "…"]
    rows = [_paper(i, random.choice(base), random.choice([None, 2001, 2002])) for i in range(1, 120)]
    rows += rows[:5]  # delivered twice
    got = {r.paper_id: (r.group_id, r.n_copies) for r in C.copy_groups(_papers(spark, rows)).collect()}
    groups = defaultdict(set)
    for r in rows:
        key = C.canonical(r[1], r[2])
        groups[key if key[0] else ("alone", r[0])].add(r[0])
    want = {i: (min(g), len(g)) for g in groups.values() for i in g}
    assert got == want
    pairs = {(r.paper_id_a, r.paper_id_b) for r in C.copy_pairs(C.copy_groups(_papers(spark, rows))).collect()}
    assert pairs == {p for g in groups.values() for p in itertools.combinations(sorted(g), 2)}


def test_empty_table(spark):
    empty = _papers(spark, [])
    assert C.copy_groups(empty).count() == 0 and C.copy_pairs(C.copy_groups(empty)).count() == 0


def test_the_filter_grows_with_the_keys():
    """At any number of keys few single ones pass: the filter has at least 16 bits a key, in slices of a bounded size."""
    assert C.filter_bits(10**9) >= 16 * 10**9 and C.filter_bits(10**9) // C.SLICE_BITS == 16
    import pyarrow as pa

    rng = np.random.default_rng(6)
    n, bits = 1 << 18, C.filter_bits(1 << 18)
    h = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
    parts = [list(C._partition_filters(bits)(iter([pa.RecordBatch.from_arrays([pa.array(x)], ["h"])]))) for x in np.array_split(rng.permutation(h), 5)]
    words = np.zeros(bits // 64, np.uint64)
    for c in {b.column(0)[0] for p in parts for b in p}:
        for b in C._merge_chunk((c,), iter([x for p in parts for x in p if x.column(0)[0] == c])):
            words[c.as_py() * C._CHUNK :][: C._CHUNK] = C._unpacked(b.column(1)[0].as_py())
    assert C._have(words, C._places(h.view(np.uint64), bits)).mean() < 0.02


def test_slices_of_the_filter_lose_nothing(spark):
    rows = [_paper(i, f"title {i // 2}", 2000) for i in range(9000)]
    full = C.copy_groups(_papers(spark, rows), slice_bits=1 << 16).where("n_copies = 2").count()
    assert full == 9000


GOOD = "A whole abstract stands here. It has two sentences."


def test_survivors(spark):
    rows = [
        _paper(1, "T", 2000, "10.5555", GOOD[:30], "PROCESSED", "feed-a", 1),
        _paper(2, "t!", 2000, "10.5555/x.1", GOOD, "verified", "FEED A ", 2),
        _paper(3, "T.", 2000, "https://doi.example/10.5555/X.1", "You need a subscription to read this abstract. Please sign in through your library.", "Verified ", "repo-b", 3),
        _paper(4, "T", 2000, "10.xxxx/xxxxx", "N/A", "nonsense", "unknown", 4),
        _paper(5, "alone", 2000, "10.5555/y", GOOD, "VERIFIED", "repo-b", 5),
        _paper(6, "empty", 1999), _paper(7, "EMPTY", 1999, None, " ", None, None, 9),
    ]
    papers = _papers(spark, rows)
    sources = spark.createDataFrame([("feed-a", 1), ("repo-b", 2)], "source_name string, trust_rank int")
    got = {(r.group_id, r.field_name): r.paper_id for r in C.survivors(papers, sources, C.copy_groups(papers)).collect()}
    assert got == {(1, "doi"): 3, (1, "abstract"): 2, (1, "metadata_status"): 3, (1, "source_name"): 2, (6, "metadata_status"): 6}


@pytest.mark.parametrize(
    "text,ok",
    [
        (GOOD, True), ("共保留条记录。", True), (None, False), ("", False), ("N/A", False), ("See PDF.", False), ("No abstract available.", False), ("[abstract missing]", False), ("Abstract not provided by the publisher.", False),
        ("It was cut in the mid", False), ("It was cut…", False), ("It was cut [truncated]", False), ("It was cut (more)", False), ("Cut ...", False), ("Please sign in to see the text of this record.", False),
    ],
)
def test_whole_abstract(spark, text, ok):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, text)], "paper_id long, abstract string")
    groups = spark.createDataFrame([(1, 1, 2)], "paper_id long, group_id long, n_copies long")
    found = C.notice_counts(df, groups).first()
    assert df.select(C.whole_abstract(df.abstract, F.lit(found.notices if found else 0)).alias("x")).first().x == ok


def test_what_many_records_say_is_a_notice(spark):
    said = "This site keeps the text elsewhere. Come back with the form."
    rows = [_paper(i, f"t{i // 2}", 2000, abstract=f"{said} Ours is number {i}." if i == 12 else said if i < 12 else f"{GOOD} We say one. We say two. {said}") for i in range(2, 16)]
    papers = _papers(spark, rows)
    groups = C.copy_groups(papers)
    got = {r.paper_id: r.notices for r in C.notice_counts(papers, groups).collect()}
    assert got == {i: 2 for i in range(2, 16)}
    sources = spark.createDataFrame([], "source_name string, trust_rank int")
    assert {r.paper_id for r in C.survivors(papers, sources, groups).where("field_name = 'abstract'").collect()} == {13, 14}  # of equally good ones the smaller id


def test_spelling_groups_and_found(spark):
    papers = spark.createDataFrame([(1, "Wear"), (2, "Weаr"), (3, None), (4, "Wear")], "paper_id long, title string")
    names = spark.createDataFrame([(1, "Ann Lee"), (1, "Ann Lee"), (2, "Ann Lee"), (3, "")], "authorship_id long, author_name_as_published string")
    found = {(r.field_name, r.row_id) for r in T.imitating_values(papers, names).collect()}
    assert found == {("papers.title", 2), ("authorships.author_name_as_published", 1)}
    groups = {(r.reader_form, r.n_spellings, r.n_rows) for r in T.spelling_groups(T.spelled_values(papers, names)).collect()}
    assert groups == {("Wear", 2, 3), ("Ann Lee", 2, 2)}
