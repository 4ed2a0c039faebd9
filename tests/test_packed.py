"""Packed values against a parser that goes character by character."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stemma.operators.packed import split_values, unpacked

CASES = [
    (', corrosion, solar stills', ["corrosion", "solar stills"]), ("a ; b||c | d", ["a", "b", "c", "d"]), ("x / I/O / e-learning", ["x", "I/O", "e-learning"]), ('a,"b, c";d', ["a", "b, c", "d"]),
    ('"the ""lock-in"" range"; f', ['the "lock-in" range', "f"]), ('"""smart"" m", n', ['"smart" m', "n"]), ('["\\"s\\" m", "q"]', ['"s" m', "q"]), ('{"a b",c d}', ["a b", "c d"]), ("'l, f'; o'neill, x", ["l, f", "o'neill", "x"]),
    ("“n, d”|b", ["n, d", "b"]), ("1. a 2. b 3. c", ["a", "b", "c"]), ("(1) a, (2) b", ["a", "b"]), ("1) a; 2) b", ["a", "b"]), ("- a\n- b", ["a", "b"]), ("* a\r\n* b", ["a", "b"]), ("• a • b", ["a", "b"]), ("a · b", ["a", "b"]),
    ("a、b，c；d", ["a", "b", "c", "d"]), ("a<br>b<BR />c<br/>d", ["a", "b", "c", "d"]), ("pH (f, l);x", ["pH (f, l)", "x"]), ("a\tb", ["a", "b"]), ("", []), (None, []), (" ", []), (",;", []), ('["\\u03b4-x"]', ["δ-x"]), ("one", ["one"]),
    ("version 2. x", ["version 2. x"]), ("a (b, c", ["a (b", "c"]), ('5" pipe, x', ['5" pipe', "x"]), ("dup, dup", ["dup", "dup"]),
    ("x (a (b, c), d), y", ["x (a (b, c), d)", "y"]), ("a) (b, (c, d)), e (f, g", ["a) (b, (c, d))", "e (f", "g"]), ("\u2003a\u2003, b\u205f;\u1680c", ["a", "b", "c"]), ("1. a 7. b 2. c 3. d", ["a 7. b", "c", "d"]), ("a\u0085b", ["a", "b"]),
    (" ".join(f"{i}. v{i}" for i in range(1, 1001)), [f"v{i}" for i in range(1, 1001)]),
]


def test_cases_together_and_alone():
    cells = [c for c, _ in CASES]
    lists, parents = split_values(pa.array(cells, pa.string()))
    assert lists.to_pylist() == [v for _, v in CASES]
    assert list(parents) == [i for i, (_, v) in enumerate(CASES) for _ in v]
    for c, v in CASES:
        assert split_values(pa.array([c], pa.string()))[0].to_pylist() == [v]


@pytest.mark.parametrize("n", [0, 1])
def test_empty_batches(n):
    assert split_values(pa.array([None] * n, pa.string()))[0].to_pylist() == [[]] * n


VALUE = st.text("abé日x-/' ", min_size=1, max_size=8).map(lambda s: " ".join(s.split())).filter(lambda s: s and s[0] not in "-' /" and s[-1] not in "-' /" and " /" not in s and "/ " not in s and " '" not in s and "' " not in s)
TIE = st.sampled_from([", ", ";", " | ", "\n", "、", " / ", "\t", "||", " • "])


def _brute(text):
    """Character by character, for plain double quotes only."""
    out, now, inside, i = [], "", False, 0
    while i < len(text):
        c = text[i]
        if c == '"':
            if inside and text[i + 1 : i + 2] == '"':
                now += '"'
                i += 1
            else:
                inside = not inside
        elif not inside and (c in ",;|\n\t、•" or c == "/" and text[i - 1 : i] == " " and text[i + 1 : i + 2] == " "):
            out.append(now)
            now = ""
        else:
            now += c
        i += 1
    return [x.strip() for x in [*out, now] if x.strip()]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(VALUE, st.booleans(), TIE), max_size=5), max_size=6))
def test_against_brute_force(rows):
    cells = ["".join((f'"{v}, {v}"' if q else v) + t for v, q, t in r) for r in rows]
    assert split_values(pa.array(cells, pa.string()))[0].to_pylist() == [_brute(c) for c in cells]


def test_long_cells_and_rows(spark):
    cell = "; ".join(f"value {i}" for i in range(50_000))
    rows = [("f", 1, cell, "clash"), ("f", 2, None, "clash"), ("f", 3, "a, b", "clash"), ("f", 3, "a, b", "clash")]
    df = spark.createDataFrame(rows, "field_name string, row_id long, cell string, item string")
    got = unpacked(df).collect()
    assert sum(r.row_id == 1 for r in got) == 50_000 and max(r.item_pos for r in got if r.row_id == 1) == 50_000
    assert sorted((r.item_pos, r.item) for r in got if r.row_id == 3) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    assert unpacked(df.limit(0)).count() == 0
