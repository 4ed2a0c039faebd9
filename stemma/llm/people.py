"""Variant spellings of people's names: links between the rows that mean one person.

Family names of all readings of all names go through the trie join. Rows meet at one institution
(whose spellings go through the trie join too) by a family name, and, where one of them names no
institution, by a family name and a given name, an initial or a short form of it. So rows of a common
family name are never multiplied out. Each distinct pair of spellings is compared once (token order,
initials, short forms, typos). A different institution separates people of the same name; an absent
one says nothing.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemma.llm.names import NICKNAMES, edits, first_letters, fold, institution, name_keys, name_score, readings, whole
from stemma.llm.trie_join import near_words
from stemma.session import Scratch, spread, written

#: Least name score with the same institution, and with an absent one.
SAME_PLACE = 0.5
NO_PLACE = 0.81
#: Name score from which a name has no typo.
NO_TYPO = 0.97
#: Letters from which an institution's name may have a typo.
LONG_PLACE = 5
#: Keys of names whose words are joined at once. More of them are joined in rounds, so that what is shuffled at a time is bounded.
KEYS_A_ROUND = 2_000_000

_KEYS = T.ArrayType(
    T.StructType([T.StructField("word", T.StringType()), T.StructField("given", T.StringType()), T.StructField("letters", T.ArrayType(T.StringType())), T.StructField("sure", T.BooleanType())])
)


@F.pandas_udf(_KEYS)
def _name_keys(names: pd.Series, others: pd.Series) -> pd.Series:
    def keys(*spelled: str | None) -> list[dict]:
        return [{"word": w, "given": g, "letters": first_letters(g), "sure": s} for n in spelled if isinstance(n, str) for w, g, s in name_keys(n)]

    return pd.Series([keys(*x) for x in zip(names, others)])


@F.pandas_udf(T.StringType())
def _other_name(full: pd.Series, last: pd.Series) -> pd.Series:
    """The full name with the family name as the own column spells it, where that differs a little."""

    def other(f: str | None, n: str | None) -> str | None:
        if not isinstance(f, str) or not isinstance(n, str):
            return None
        found = [x for x, _ in readings(f"{n}, X")[0]]
        for family, givens in readings(f)[0]:
            if found and found[0] != family and edits(whole(found[0]), whole(family), 2) <= 2 and len(family) > 4:
                return f"{n}, {' '.join(givens)}"
        return None

    return pd.Series([other(f, n) for f, n in zip(full, last)])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _folded_words(names: pd.Series) -> pd.Series:
    return names.map(lambda n: [fold(w) for w in n.replace(",", " ").split()] if isinstance(n, str) else [])


@F.pandas_udf(T.DoubleType())
def _name_score(a: pd.Series, other_a: pd.Series, b: pd.Series, other_b: pd.Series) -> pd.Series:
    """Best score of the spellings of one side against those of the other; the other spellings of both are not compared."""

    def best(x: str | None, u: str | None, y: str | None, v: str | None) -> float:
        return max((name_score(p, q) for p, q in ((x, y), (x, v), (u, y)) if isinstance(p, str) and isinstance(q, str)), default=0.0)

    return pd.Series([best(*row) for row in zip(a, other_a, b, other_b)], dtype=float)


_PLACE = T.StructType([T.StructField("place", T.StringType()), T.StructField("kind", T.StringType())])


@F.pandas_udf(_PLACE)
def _place_parts(places: pd.Series) -> pd.DataFrame:
    found = [institution(p) if isinstance(p, str) else None for p in places]
    return pd.DataFrame({"place": [f[0] or None if f else None for f in found], "kind": [f[1] if f else None for f in found]})


def with_place(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``place``) and ``at``, the institution's place and kind, worked out once a row."""
    return rows.withColumn("at", _place_parts("place"))


def digits(c: Column, n: int) -> Column:
    """An identifier in any notation as its bare ``n`` characters; null for placeholders and what is none."""
    last = F.regexp_extract(F.upper(F.regexp_replace(c, r"(?<=\d)\.0+\s*$", "")), r"([0-9][0-9\s\-–—‐‑.]*X?)\s*/?\s*$", 1)
    bare = F.regexp_replace(last, r"[^0-9X]", "")
    tail = F.substring(bare, -1, 1)
    same = F.length(F.replace(bare, tail, F.lit(""))) == 0
    return F.when(bare.rlike(rf"^\d{{{n - 1}}}[\dX]$") & ~same, bare)


def roster(professors: DataFrame, departments: DataFrame | None) -> DataFrame:
    """``professor_id, name, other, place, orcid, scholar``; the department's institution goes before the own spelling of it."""
    p = professors.select("professor_id", "full_name", "last_name", "institution", "department_id", "orcid", "semantic_scholar_id").dropDuplicates(["professor_id"])
    place = F.when(F.trim("institution") != "", F.col("institution"))
    if departments is not None:
        d = departments.select(F.col("department_id").alias("d_id"), F.col("institution").alias("d_place")).dropDuplicates(["d_id"])
        p = p.join(d, p.department_id == d.d_id, "left")
        place = F.coalesce("d_place", place)
    return with_place(p.withColumn("place", place)).select(
        "professor_id",
        F.col("full_name").alias("name"),
        "last_name",
        _other_name("full_name", "last_name").alias("other"),
        "place",
        "at",
        digits(F.col("orcid"), 16).alias("orcid"),
        digits(F.col("semantic_scholar_id"), 11).alias("scholar"),
    )


def given_words(professors: DataFrame) -> DataFrame:
    """``word``: parts of names that are given names far more often than family names."""
    first = professors.select(F.explode(_folded_words(F.concat_ws(" ", "first_name", "middle_name"))).alias("word"), F.lit(1).alias("given"))
    last = professors.select(F.explode(_folded_words("last_name")).alias("word"), F.lit(0).alias("given"))
    n = first.unionByName(last).groupBy("word").agg(F.sum("given").alias("given"), F.count(F.lit(1)).alias("n"))
    return n.where("given >= 3 and given > 2 * (n - given) and length(word) > 1").select("word")


def same_kinds(a: Column, b: Column) -> Column:
    """Whether kinds of institutions agree; an open kind agrees with all, ``universi?`` with the kinds it may stand for."""
    may = lambda x, y: (x == "universi?") & y.isin("universidad", "universite", "university")
    return (a == b) | (a == "?") | (b == "?") | may(a, b) | may(b, a)


def near_places(a: DataFrame, b: DataFrame, near: DataFrame) -> DataFrame:
    """``at, other``: distinct institutions (column ``at`` of both sides) that are the same one, perhaps with a typo (``near``)."""
    own = a.where("at.place is not null").select("at").distinct()
    theirs = b.where("at.place is not null").select(F.col("at").alias("other")).distinct()
    near = near.where((F.col("distance") == 0) | (F.least(F.length("probe"), F.length("word")) >= LONG_PLACE))
    both = own.join(near, F.col("at.place") == F.col("probe")).join(theirs, F.col("other.place") == F.col("word"))
    return both.where(same_kinds(F.col("at.kind"), F.col("other.kind"))).select("at", "other")


def near_givens(near: DataFrame) -> DataFrame:
    """``own, theirs``: full given names that are equal, nearly so (``near``), or one the short form of the other."""
    short = [(k, n) for k, v in NICKNAMES.items() for n in v.split()]  # a fixed table
    table = near.sparkSession.createDataFrame(short + [(n, k) for k, n in short], "own string, theirs string")
    return near.where("length(probe) > 1").select(F.col("probe").alias("own"), F.col("word").alias("theirs")).unionByName(table).distinct()


def spelled(rows: DataFrame, givens: DataFrame) -> DataFrame:
    """``name_id, word, given, letters`` of distinct names (``name_id, name, other``).

    A part that is commonly a given name is no family name, unless the name says it is, or nothing
    would be left to find the name by.
    """
    keys = rows.select("name_id", F.explode(_name_keys("name", "other")).alias("k"))
    common = givens.select(F.col("word").alias("common"))
    keys = keys.join(common, F.col("k.word") == F.col("common"), "left").select("name_id", F.struct("k.*", (~F.col("k.sure") & F.col("common").isNotNull()).alias("doubtful")).alias("k"))
    one = keys.groupBy("name_id").agg(F.collect_set("k").alias("all")).withColumn("firm", F.filter("all", lambda k: ~k["doubtful"]))  # a name has a few keys
    return one.select("name_id", F.explode(F.when(F.size("firm") > 0, F.col("firm")).otherwise(F.col("all"))).alias("k")).select("name_id", "k.word", "k.given", "k.letters")


class Meeting:
    """Candidates between rows of two sides (``id, name_id, at``), whose names' keys are ``keys``."""

    def __init__(self, tables: Scratch, a: DataFrame, b: DataFrame, keys: DataFrame):
        self.a, self.b = (x.select("id", "name_id", "at") for x in (a, b))
        self.keys, self.tables = keys, tables

        def vocabulary(rows: DataFrame) -> DataFrame:
            own = keys.join(rows, "name_id", "left_semi")
            return own.select(F.explode(F.array_distinct(F.array("word", "given"))).alias("word")).unionByName(rows.select(F.col("at.place").alias("word")))

        self.passing: list[DataFrame] = []
        self.size = keys.count()
        n = self.rounds(KEYS_A_ROUND)
        # one join for family names, given names and institutions alike
        words = [vocabulary(x) for x in (self.a, self.b)]
        if n > 1:
            words = [self._passing(x.where("word <> ''").distinct(), "words") for x in words]
        self.near = self._united([near_words(*words, 1, part=(k, n)) for k in range(n)], "near")
        self.dropped()
        theirs = self.b.where("at.place is not null").select(F.col("at").alias("other")).distinct()
        self.numbers = tables.written(theirs.withColumn("no", F.monotonically_increasing_id()), "institutions")
        self.places = tables.written(near_places(a, b, self.near).join(self.numbers, "other"), "places")

    def rounds(self, keys: int) -> int:
        return max(1, -(-self.size // keys))

    def _passing(self, df: DataFrame, label: str) -> DataFrame:
        self.passing.append(self.tables.written(df, label))
        return self.passing[-1]

    def _united(self, shares: list[DataFrame], label: str) -> DataFrame:
        """Distinct rows of all shares, which are written one after the other."""
        if len(shares) == 1:
            return self.tables.written(shares[0], label)
        return self.tables.written(reduce(DataFrame.unionByName, [self._passing(x, label) for x in shares]).distinct(), label)

    def dropped(self) -> None:
        """Delete the tables that only steps before this one read."""
        self.tables.dropped(*self.passing)
        self.passing = []

    def at_place(self, marks: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
        """``id_a, id_b, name_a, name_b`` of rows at one institution that share a family name or nearly do.

        Of each institution the family names of side b are one trie. ``marks`` (``id, mark`` of both
        sides) are further things to meet by in the same way: rows of equal mark.
        """
        words = self.keys.select("name_id", "word").distinct()
        where = F.concat(F.lit("@"), F.col("no")).alias("by")
        a = self.a.where("at.place is not null").join(self.places, "at").select("id", "name_id", where)
        b = self.b.where("at.place is not null").join(self.numbers, F.col("at") == F.col("other")).select("id", "name_id", where)
        if marks:
            a = a.unionByName(self.a.join(marks[0], "id").select("id", "name_id", F.col("mark").alias("by")))
            b = b.unionByName(self.b.join(marks[1], "id").select("id", "name_id", F.col("mark").alias("by")))
        a, b = self._passing(a.join(words, "name_id"), "words"), self._passing(b.join(words, "name_id"), "words")
        near = self._passing(near_words(a, b, 2, by="by").select("by", "probe", F.col("word").alias("near")), "near")
        a = a.select(F.col("id").alias("id_a"), F.col("name_id").alias("name_a"), "by", F.col("word").alias("probe")).join(near, ["by", "probe"])
        b = b.select(F.col("id").alias("id_b"), F.col("name_id").alias("name_b"), "by", F.col("word").alias("near"))
        return a.join(b, ["by", "near"]).select("id_a", "id_b", "name_a", "name_b", F.col("by").startswith("@").alias("placed")).distinct()

    def anywhere(self) -> DataFrame:
        """``name_a, name_b`` of names that nearly share family name and given name, where a row of one of them has no institution.

        A full given name meets near ones, short forms and its initials; an initial meets all it may stand for.
        """

        def armed(rows: DataFrame, both: bool) -> DataFrame:
            # arm 0: side a is somewhere unknown; arm 1: side b is, and side a is not
            has = rows.groupBy("name_id").agg(F.max(F.col("at.place").isNull()).alias("lost"), F.max(F.col("at.place").isNotNull()).alias("found"))
            arms = F.array_compact(F.array(F.when(F.lit(True) if both else F.col("lost"), 0), F.when(F.col("lost") if both else F.col("found"), 1)))
            return self._passing(self.keys.where("given <> ''").join(has.select("name_id", F.explode(arms).alias("arm")), "name_id"), "armed")

        a, b = armed(self.a, False), armed(self.b, True)
        near = self.near.where("distance = 0 or length(probe) >= 5 and length(word) >= 5").select("probe", F.col("word").alias("near"))
        full, one = F.length("given") > 1, F.length("given") == 1
        marked = lambda mark, c: F.concat(F.lit(mark), c)
        letters = lambda mark: F.transform("letters", lambda x: F.concat(F.lit(mark), x))
        # the pairs of family names that names of both sides have: few rows without an institution leave few of them
        own, theirs = (x.select(F.col("word").alias(k), "arm").distinct() for x, k in ((a, "probe"), (b, "near")))
        meet = self._passing(near.join(theirs, "near").join(own, ["probe", "arm"], "left_semi"), "families")
        # names meet by a number: should two things have one, names that do not fit meet, and get no score
        met_by = F.xxhash64("near", "arm", "key").alias("by")
        x = a.join(meet.withColumnRenamed("probe", "word"), ["word", "arm"]).join(near_givens(self.near), F.col("given") == F.col("own"), "left")
        x = x.select(F.col("name_id").alias("name_a"), "near", "arm", F.explode(F.when(one, F.array(marked("i", F.col("given")))).otherwise(F.concat(F.array_compact(F.array(marked("g", F.col("theirs")))), letters("p")))).alias("key"))
        y = b.withColumnRenamed("word", "near").join(meet.select("near", "arm").distinct(), ["near", "arm"], "left_semi")
        y = y.select(F.col("name_id").alias("name_b"), "near", "arm", F.explode(F.when(full, F.concat(F.array(marked("g", F.col("given"))), letters("i"))).otherwise(F.array(marked("i", F.col("given")), marked("p", F.col("given"))))).alias("key"))
        return x.select("name_a", met_by).distinct().join(y.select("name_b", met_by), "by").select("name_a", "name_b").distinct()


def rated(pairs: DataFrame, names: DataFrame, least: float) -> DataFrame:
    """``name_a, name_b, score`` of distinct pairs of names that do not contradict each other."""
    pairs = pairs.select("name_a", "name_b").distinct()
    x = names.select(F.col("name_id").alias("name_a"), F.col("name").alias("text_a"), F.col("other").alias("other_a"))
    y = names.select(F.col("name_id").alias("name_b"), F.col("name").alias("text_b"), F.col("other").alias("other_b"))
    both = spread(pairs.join(x, "name_a").join(y, "name_b"))
    score = _name_score("text_a", "other_a", "text_b", "other_b")
    return both.select("name_a", "name_b", score.alias("score")).where(F.col("score") >= least)


def names_of(rows: DataFrame) -> DataFrame:
    """Distinct names of rows: ``name_id, name, other``."""
    return rows.where("name is not null").groupBy("name_id").agg(F.min("name").alias("name"), F.min("other").alias("other"))


def name_id(name: Column, other: Column) -> Column:
    return F.md5(F.to_json(F.array(name, other)))


def _identifiers(people: DataFrame) -> DataFrame:
    """``id, mark``: each identifier of a professors row."""
    return people.select("id", F.explode(F.array_compact(F.array(F.concat(F.lit("o"), "orcid"), F.concat(F.lit("s"), "scholar")))).alias("mark"))


def author_links(professors: DataFrame, departments: DataFrame | None, authorships: DataFrame) -> DataFrame:
    """``link_kind, id_a, id_b``: unresolved authorships with their professor, and professors rows of one person.

    An authorship delivered twice counts once; spellings are compared once however many rows have
    them. A name that fits several people equally well and has no institution to tell is not linked,
    nor is one that fits only with a typo and is somebody's at another institution as it stands. Null and blank names are linked to nobody.
    """
    spark = professors.sparkSession
    with Scratch(spark) as tables:
        listed = tables.written(roster(professors, departments).select("professor_id", "name", "other", "at", "orcid", "scholar"), "roster")
        place = F.when(F.trim("institution") != "", F.col("institution"))
        rows = authorships.where("professor_id is null and author_name_as_published is not null").select("authorship_id", F.col("author_name_as_published").alias("name"), place.alias("place")).dropDuplicates(["authorship_id"])
        rows = tables.written(rows, "unresolved")
        # names and rows of both sides are numbered, since every step has them; spellings have even numbers
        number = lambda odd: 2 * F.monotonically_increasing_id() + odd
        spellings = tables.written(rows.select("name", "place").distinct().withColumn("id", number(0)), "spellings")
        none = F.lit(None).cast("string").alias("other")
        names = spellings.select("name", none).unionByName(listed.select("name", "other")).where("name is not null").distinct()
        names = tables.written(names.withColumn("name_id", F.monotonically_increasing_id()), "names")
        known = names.select("name_id", F.col("name").alias("text"), F.col("other").alias("text_2"))
        people = listed.join(known, (F.col("name") == F.col("text")) & F.col("other").eqNullSafe(F.col("text_2")), "left")
        people = tables.written(people.select(F.when(F.col("professor_id").isNotNull(), number(1)).alias("id"), "professor_id", "name_id", "at", "orcid", "scholar"), "people")
        own = with_place(spellings.join(known.where("text_2 is null"), F.col("name") == F.col("text")).select("id", "name_id", "place"))
        # side a: the unresolved spellings, and the professors rows themselves
        parts = ["id", "name_id", "at"]
        sides = tables.written(own.select(*parts, F.lit(True).alias("author")).unionByName(people.select(*parts, F.lit(False).alias("author"))), "sides")
        theirs = spellings.select("id", F.col("name").alias("text"), F.col("place").alias("text_2"))
        spelled_as = tables.written(rows.join(theirs, (F.col("name") == F.col("text")) & F.col("place").eqNullSafe(F.col("text_2"))).select("authorship_id", "id"), "authorships")
        tables.dropped(listed, rows, spellings)
        keys = tables.written(spelled(names, given_words(professors)), "keys")
        met = Meeting(tables, sides, people, keys)
        marks = _identifiers(people)
        there = tables.written(met.at_place((marks, marks)), "at-place")
        met.dropped()
        anywhere = tables.written(met.anywhere(), "anywhere")
        met.dropped()
        tables.dropped(met.near)
        scores = tables.written(rated(there.select("name_a", "name_b").unionByName(anywhere), names, 0.4), "scores")
        tables.dropped(anywhere, names)
        asked = sides.select(F.col("id").alias("id_a"), F.col("name_id").alias("name_a"), F.col("at.place").isNull().alias("lost_a"), "author")
        links = tables.written(_professor_links(people, met, there, asked, scores), "professor-links")
        found = spelled_as.join(_chosen(tables, people, met, there, asked, scores, links), spelled_as.id == F.col("id_a"))
        found = found.select(F.lit("authorship").alias("link_kind"), F.col("authorship_id").alias("id_a"), F.col("professor_id").alias("id_b"))
        return written(found.unionByName(links.select(F.lit("professor").alias("link_kind"), "id_a", "id_b")), "links")


def _professor_links(people: DataFrame, met: Meeting, there: DataFrame, asked: DataFrame, scores: DataFrame) -> DataFrame:
    """``id_a, id_b``: pairs of professors rows of one person, the smaller id first.

    Rows with an equal identifier need less of a name, but one that is near, and no other institution.
    """
    b = people.select(F.col("id").alias("id_b"), F.col("name_id").alias("name_b"), F.col("at.place").isNull().alias("lost_b"))
    own = asked.where("not author").select("id_a", "name_a", "lost_a")
    lost = F.col("lost_a") | F.col("lost_b")
    apart = scores.where(F.col("score") >= NO_PLACE).join(own, "name_a").join(b, "name_b").where(lost).select("id_a", "id_b", F.lit(True).alias("ok"))
    near = there.join(scores, ["name_a", "name_b"]).join(own.select("id_a"), "id_a", "left_semi").select("id_a", "id_b", (F.col("placed") & (F.col("score") >= SAME_PLACE)).alias("ok"))
    pairs = near.unionByName(apart).where("id_a <> id_b")
    pairs = pairs.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), "ok").groupBy("id_a", "id_b").agg(F.max("ok").alias("ok"))
    ids = people.select("id", "professor_id", "orcid", "scholar", "at")
    x = ids.select(*(F.col(c).alias(f"{c}_a") for c in ids.columns))
    y = ids.select(*(F.col(c).alias(f"{c}_b") for c in ids.columns))
    both = pairs.join(x, "id_a").join(y, "id_b")
    both = both.join(met.places, (F.col("at_a") == F.col("at")) & (F.col("at_b") == F.col("other")), "left")
    agree = lambda f: F.coalesce(f("orcid"), F.lit(False)) | F.coalesce(f("scholar"), F.lit(False))
    same = agree(lambda c: F.col(f"{c}_a") == F.col(f"{c}_b"))
    other = agree(lambda c: F.col(f"{c}_a") != F.col(f"{c}_b"))
    elsewhere = F.col("at_a.place").isNotNull() & F.col("at_b.place").isNotNull() & F.col("at").isNull()
    return both.where((F.col("ok") & (same | ~other)) | (same & ~elsewhere)).select(F.least("professor_id_a", "professor_id_b").alias("id_a"), F.greatest("professor_id_a", "professor_id_b").alias("id_b"))


def _chosen(tables: Scratch, people: DataFrame, met: Meeting, there: DataFrame, asked: DataFrame, scores: DataFrame, links: DataFrame) -> DataFrame:
    """``id_a, professor_id``: the person of each unresolved spelling, all rows of the person that fit.

    Of a spelling that many people have it is enough to know that there are two.
    """
    # the person of a row: the smallest id it is linked to
    first = links.groupBy(F.col("id_b").alias("professor_id")).agg(F.min("id_a").alias("first"))
    known = people.select("professor_id", "id", "name_id", F.col("at.place").isNull().alias("lost_b")).join(first, "professor_id", "left").withColumn("person", F.coalesce("first", "professor_id"))
    known = tables.written(known.drop("first"), "known")
    asked = asked.where("author").drop("author")
    good = scores.where(F.col("score") >= SAME_PLACE)
    near = there.where("placed").join(asked.select("id_a"), "id_a", "left_semi").join(good, ["name_a", "name_b"]).join(known.select(F.col("id").alias("id_b"), "professor_id", "person"), "id_b")
    near = near.select("id_a", (F.col("score") + 2.0).alias("rank"), F.col("person").alias("low"), F.col("person").alias("high"), "professor_id")
    owners = known.groupBy(F.col("name_id").alias("name_b"), "lost_b").agg(F.min("person").alias("low"), F.max("person").alias("high"))
    fits = good.where(F.col("score") >= NO_PLACE).join(owners, "name_b").join(asked, "name_a").where("lost_a or lost_b")
    fits = fits.select("id_a", F.col("score").alias("rank"), "low", "high", F.lit(None).cast("bigint").alias("professor_id"), "name_b", "lost_b")
    ranked = near.select("id_a", "rank", "low", "high", "professor_id", F.lit(None).cast("string").alias("name_b"), F.lit(None).cast("boolean").alias("lost_b"))
    ranked = tables.written(ranked.unionByName(fits), "ranked")
    best = ranked.groupBy("id_a").agg(F.max("rank").alias("best"))
    top = ranked.join(best, "id_a").where("rank >= best - 0.001").groupBy("id_a").agg(F.min("low").alias("person"), F.max("high").alias("high")).where("person = high").select("id_a", "person")
    own = tables.written(ranked.where("low = high").join(top, "id_a").where("low = person").select("id_a", "professor_id", "name_b", "lost_b", "rank"), "own")
    rows_of = known.select(F.col("name_id").alias("name_b"), "lost_b", "professor_id")
    by_name = own.where("professor_id is null").select("id_a", "name_b", "lost_b", "rank").join(rows_of, ["name_b", "lost_b"])
    by_name = tables.written(by_name.join(asked, "id_a").select("id_a", "professor_id", "rank", "name_a", "lost_a"), "by-name")
    other = _namesakes(by_name.where(F.col("lost_a") & (F.col("rank") < NO_TYPO)), people, met, asked)
    by_name = by_name.join(other, ["id_a", "professor_id"], "left_anti").select("id_a", "professor_id")
    return own.where("professor_id is not null").select("id_a", "professor_id").unionByName(by_name).distinct()


def _namesakes(doubtful: DataFrame, people: DataFrame, met: Meeting, asked: DataFrame) -> DataFrame:
    """``id_a, professor_id`` of links by a name with a typo, where somebody publishes under that very name at another institution."""
    # by the longest family name of a name, not by a part of one
    longest = met.keys.where("length(given) > 1").groupBy("name_id").agg(F.max(F.struct(F.length("word").alias("n"), "word", "given")).alias("k"))
    full = longest.select("name_id", "k.word", "k.given")
    theirs = asked.where("not lost_a").join(full, F.col("name_a") == F.col("name_id")).join(met.a.select(F.col("id").alias("id_a"), "at"), "id_a").select("word", "given", "at").distinct()
    own = doubtful.join(full, F.col("name_a") == F.col("name_id")).join(people.where("at.place is not null").select("professor_id", F.col("at").alias("at_b")), "professor_id")
    met_at = own.join(theirs, ["word", "given"]).join(met.places.select(F.col("at").alias("near"), F.col("other").alias("near_b")), (F.col("at") == F.col("near")) & (F.col("at_b") == F.col("near_b")), "left_anti")
    return met_at.select("id_a", "professor_id").distinct()
