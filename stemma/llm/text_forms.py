"""One consistent form for text that looks the same but is spelled with other characters.

The method is a confusables skeleton: decompose, replace each character by its prototype from a
look-alike table, decompose again. Whether a letter only imitates another depends on the word and
the value it stands in (a Cyrillic ``a`` is an imitation inside a Latin word but not in a Russian
title), so the replacement looks at scripts word by word.

The letters most often met are listed below. All other look-alikes of Latin letters come from the
Unicode confusables data as the Spark distribution carries them (in its ICU library), read once by
each worker: a letter of any other script, or of phonetic notation, that stands in a word with Latin
letters, or a word of such letters among Latin words. Letters of ordinary Latin orthographies, and
symbols and numerals that stand alone, are themselves.

``reader_form`` gives the text as a reader sees it, ``skeleton`` the decomposed key for grouping.
"""

from __future__ import annotations

import functools
import glob
import os
import re
import struct
import unicodedata
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts and the Latin letters they look like.
CYRILLIC = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ѵ": "v",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ӏ": "I", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "Һ": "H",
    "Ԁ": "D", "Ѵ": "V",
}
GREEK = {
    "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "κ": "k", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C",
}
ARMENIAN = {"օ": "o", "ս": "u", "ո": "n", "հ": "h", "ց": "g", "զ": "q", "Օ": "O", "Տ": "S", "Լ": "L"}
LATIN = {"ɡ": "g", "ɑ": "a", "ɩ": "i", "Ɡ": "G", "ſ": "s"}

_TO_LATIN = {**CYRILLIC, **GREEK, **ARMENIAN}
_TO_CYRILLIC = {v: k for k, v in CYRILLIC.items() if v.isascii()}
_WORD = re.compile(r"(?:[^\W\d_]|[̀-ͯ])+")
_JOINERS = "‌‍"
_ALWAYS_GONE = {0x034F, 0x115F, 0x1160, 0x3164, 0xFFA0, 0x180B, 0x180C, 0x180D}


@functools.lru_cache(maxsize=1)
def confusables() -> dict[str, str]:
    """Prototype of every character of the Unicode confusables data.

    The data are those of the ICU library among the jars of the Spark distribution, which driver and
    executors have alike. A worker that cannot find them stops, so that no two differ in what they know.
    """
    import pyspark

    homes = [os.path.dirname(pyspark.__file__), os.environ.get("SPARK_HOME", "")]
    jars = [j for h in homes if h for j in sorted(glob.glob(os.path.join(h, "jars", "icu4j-*.jar")))]
    if not jars:
        raise FileNotFoundError(f"no ICU library among the jars of {homes}")
    with zipfile.ZipFile(jars[0]) as z:
        raw = z.read(next(n for n in z.namelist() if n.endswith("/confusables.cfu")))
    order = ">" if raw[8] else "<"
    body = raw[struct.unpack(">H", raw[:2])[0] :]  # behind the header, whose size comes first
    keys_at, n, values_at, _, strings_at, length = struct.unpack(f"{order}6i", body[12:36])
    keys = struct.unpack(f"{order}{n}i", body[keys_at : keys_at + 4 * n])
    values = struct.unpack(f"{order}{n}H", body[values_at : values_at + 2 * n])
    units = body[strings_at : strings_at + 2 * length].decode("utf-16-be" if order == ">" else "utf-16-le", "surrogatepass")
    out = {}
    for k, v in zip(keys, values):
        # a key: a code point and, in the upper byte, one less than the size of its prototype
        size = (k >> 24 & 0xFF) + 1
        wide = units if len(units) == length else None
        text = chr(v) if size == 1 else (wide[v : v + size] if wide is not None else body[strings_at + 2 * v : strings_at + 2 * (v + size)].decode("utf-16-be" if order == ">" else "utf-16-le", "surrogatepass"))
        out[chr(k & 0x1FFFFF)] = text
    return out


@functools.lru_cache(maxsize=1)
def lookalikes() -> dict[str, str]:
    """Letters beyond the lists above that look like Latin ones, each with what it looks like."""
    out = {}
    for o in range(0x180, 0x20000):
        c = chr(o)
        kind = unicodedata.category(c)
        if kind not in ("Lu", "Ll", "Lo", "Nl") or c in _TO_LATIN or c in LATIN or _is_cjk(c) or 0x1E00 <= o < 0x1F00 or 0x370 <= o < 0x590 or 0x1D400 <= o < 0x1D800:
            continue
        name = unicodedata.name(c, "")
        small = re.fullmatch(r"LATIN LETTER SMALL CAPITAL ([A-Z])", name)
        like = small.group(1).lower() if small else confusables().get(c, "")
        if kind == "Nl" or 0x2100 <= o < 0x2190:
            like = unicodedata.normalize("NFKC", c)
        elif kind == "Lu" and like == "l":
            like = "I"  # the data do not tell a capital i from a small l
        if like.isascii() and like.isalpha() and (len(like) == 1 or kind == "Nl"):
            out[c] = like
    return out


def _script(ch: str) -> str:
    o = ord(ch)
    if o < 0x250 or 0x250 <= o < 0x2B0 or 0x1E00 <= o < 0x1F00:
        return "L"
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "G"
    if 0x400 <= o < 0x530:
        return "C"
    if 0x530 <= o < 0x590:
        return "A"
    return "M" if unicodedata.combining(ch) else "-"


def _is_cjk(ch: str) -> bool:
    o = ord(ch)
    return 0x3001 <= o < 0x3100 or 0x3100 <= o < 0x3130 or 0x31F0 <= o < 0x3200 or 0x3400 <= o < 0xA000 or 0xAC00 <= o < 0xD7B0 or 0xF900 <= o < 0xFB00 or 0x20000 <= o < 0x32000


def _joins(ch: str) -> bool:
    """Characters between which a joiner has a meaning: Arabic, Indic and emoji."""
    o = ord(ch)
    return 0x600 <= o < 0xE00 or 0x2600 <= o < 0x27C0 or o == 0xFE0F or 0x1F000 <= o < 0x20000


def _unhidden(s: str) -> str:
    """Without invisible characters, with plain spaces, full-width forms and ligatures undone."""
    out: list[str] = []
    n = len(s)
    for i, ch in enumerate(s):
        o = ord(ch)
        if o < 0x80:
            out.append(ch)
            continue
        kind = unicodedata.category(ch)
        if kind == "Cf" or o in _ALWAYS_GONE:
            if ch in _JOINERS and 0 < i < n - 1 and _joins(s[i - 1]) and _joins(s[i + 1]):
                out.append(ch)
            continue
        if kind == "Zs":
            beside = s[i - 1 : i] + s[i + 1 : i + 2]
            out.append(ch if o == 0x3000 and any(map(_is_cjk, beside)) else " ")
        elif 0xFF01 <= o <= 0xFF5E:
            plain = chr(o - 0xFEE0)
            beside = s[i - 1 : i] + s[i + 1 : i + 2]
            out.append(ch if not plain.isalnum() and any(map(_is_cjk, beside)) else plain)
        elif 0xFB00 <= o <= 0xFB06 or 0x1D400 <= o <= 0x1D7FF:
            out.append(unicodedata.normalize("NFKC", ch))
        else:
            out.append(ch)
    return "".join(out)


def _in_script(s: str, symbols: bool) -> str:
    """Letters that imitate another script's letters, replaced by what they imitate."""
    real = {x for x in map(_script, (c for c in s if c not in _TO_LATIN and c.isalpha())) if x in "GCA"}
    # A lone Greek letter such as a delta says nothing about the language of the value.
    if "G" in real and not any(len(w) > 1 and all(_script(c) in "GM" for c in w) and any(c not in GREEK for c in w) for w in _WORD.findall(s)):
        real.discard("G")

    table = lookalikes()
    latin = any(c.isascii() and c.isalpha() for c in s)

    def fix(m: re.Match[str]) -> str:
        w = m.group()
        if latin and any(c in table for c in w) and (any(c.isascii() for c in w) or len(w) > 1 and all(c in table or c in _TO_LATIN for c in w)):
            # a stroke is a small l behind a small letter
            w = "".join("l" if table.get(c) == "I" and b.islower() else table.get(c, c) for b, c in zip(" " + w, w))
        scripts = {_script(c) for c in w} - {"M"}
        foreign = scripts & {"G", "C", "A"}
        if not foreign:
            return "".join(LATIN.get(c, c) for c in w) if any(c in LATIN for c in w) and any(c.isascii() for c in w) else w
        if "L" in scripts or len(foreign) > 1:
            own = {x for x in foreign if any(_script(c) == x and c not in _TO_LATIN for c in w)}
            if own == {"C"} and not any(c.isascii() and c not in _TO_CYRILLIC for c in w):
                return "".join(_TO_CYRILLIC.get(c, c) for c in w)
            return "".join(_TO_LATIN.get(c, LATIN.get(c, c)) for c in w)
        if foreign & real or any(_script(c) in foreign and c not in _TO_LATIN for c in w):
            return w
        if symbols and len(w) == 1 and "G" in foreign and w.islower() and w != "ο":
            return w
        return "".join(_TO_LATIN.get(c, c) for c in w)

    return _WORD.sub(fix, s)


def reader_form(s: str | None, symbols: bool = True) -> str | None:
    """The text as a reader sees it, in composed characters of one script a word.

    Null stays null. Tabs, line breaks, repeated plain spaces, typographic quotes, dashes and
    ellipses are left alone. With ``symbols`` a lone small Greek letter stands for itself.
    """
    if s is None or s.isascii():
        return s
    plain = _unhidden(s)
    if plain.isascii():
        return plain
    return unicodedata.normalize("NFC", _in_script(unicodedata.normalize("NFD", plain), symbols))


def imitates(s: str | None, symbols: bool = True) -> bool:
    """Whether at least one character of the value only imitates what a reader sees."""
    return s is not None and reader_form(s, symbols) != s


def skeleton(s: str | None, symbols: bool = True) -> str | None:
    """Key under which all spellings of one visible text are equal (decomposed reader form)."""
    return None if s is None else unicodedata.normalize("NFD", reader_form(s, symbols))


FORMS = T.StructType([T.StructField("reader_form", T.StringType()), T.StructField("skeleton", T.StringType()), T.StructField("imitates", T.BooleanType())])


def text_forms(value: Column, symbols: bool = True) -> Column:
    """Struct of ``reader_form``, ``skeleton`` and ``imitates`` for a string column."""

    @F.pandas_udf(FORMS)
    def forms(values: pd.Series) -> pd.DataFrame:
        shown = [reader_form(v, symbols) if isinstance(v, str) else None for v in values]
        return pd.DataFrame(
            {
                "reader_form": shown,
                "skeleton": [None if v is None else v if v.isascii() else unicodedata.normalize("NFD", v) for v in shown],
                "imitates": [v is not None and v != o for v, o in zip(shown, values)],
            }
        )

    return forms(value)


def spelled_values(papers: DataFrame, authorships: DataFrame) -> DataFrame:
    """``field_name, row_id, value`` of the two fields; a row that is delivered twice counts once."""
    titles = papers.select(F.lit("papers.title").alias("field_name"), F.col("paper_id").alias("row_id"), F.col("title").alias("value"))
    names = authorships.select(F.lit("authorships.author_name_as_published").alias("field_name"), F.col("authorship_id").alias("row_id"), F.col("author_name_as_published").alias("value"))
    return titles.unionByName(names.dropDuplicates(["row_id", "value"]))


def imitating_values(papers: DataFrame, authorships: DataFrame) -> DataFrame:
    """``field_name, row_id`` of each value with a character that only imitates another.

    Null and blank values are no cases. ASCII values cannot be and never reach Python. A row id
    comes out once, however often its row was delivered.
    """
    values = spelled_values(papers, authorships).where(F.col("value").rlike(r"[^\x00-\x7f]"))
    symbols = F.col("field_name") == "papers.title"
    form = F.when(symbols, text_forms(F.col("value"), True)).otherwise(text_forms(F.col("value"), False))
    found = values.select("field_name", "row_id", form["imitates"].alias("found")).where("found")
    return found.select("field_name", "row_id").dropDuplicates()


def spelling_groups(values: DataFrame) -> DataFrame:
    """Distinct spellings grouped by equal skeleton.

    ``values``: ``field_name, row_id, value``. One row a skeleton that has more than one spelling:
    ``field_name, skeleton, reader_form, n_spellings, n_rows``. Spellings are counted before they
    are brought together, so a value that fills a third of all rows moves as one row a partition.
    """
    distinct = values.where(F.col("value").isNotNull()).groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n"))
    form = text_forms(F.col("value"))
    return (
        distinct.select("field_name", "n", form.alias("f"))
        .groupBy("field_name", F.col("f.skeleton").alias("skeleton"))
        .agg(F.max("f.reader_form").alias("reader_form"), F.count(F.lit(1)).alias("n_spellings"), F.sum("n").alias("n_rows"))
        .where("n_spellings > 1")
    )
