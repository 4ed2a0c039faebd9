"""Joins beyond a plain equi-join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stemma.session import Scratch, spread, written

#: Words of titles that meet at once. More of them meet in rounds, so that what is shuffled at a time is bounded.
WORDS_A_ROUND = 500_000


def null_safe(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return reduce(lambda x, y: x & y, (p.eqNullSafe(q) for p, q in zip(a, b)))


def last_wins(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row a key: the last in order. Null keys are dropped."""
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*")


def lookup_fallback(rows: DataFrame, lookups: Sequence[tuple[str, DataFrame, str, str]], result: str = "found_id") -> DataFrame:
    """``rows`` with the first hit among several lookups, and ``found_by``.

    A lookup is ``(column of rows, table, its key column, its value column)`` with unique keys; a
    later one counts only where the earlier ones missed.
    """
    out, hits = rows, []
    for n, (column, table, key, value) in enumerate(lookups):
        t = table.select(F.col(key).alias(f"_k{n}"), F.col(value).alias(f"_v{n}"))
        out = out.join(t, F.col(column) == F.col(f"_k{n}"), "left")
        hits.append(f"_v{n}")
    by = F.lit(None).cast("string")
    for n in reversed(range(len(lookups))):
        by = F.when(F.col(hits[n]).isNotNull(), F.lit(lookups[n][0])).otherwise(by)
    return out.withColumn(result, F.coalesce(*hits)).withColumn("found_by", by).drop(*hits, *(f"_k{n}" for n in range(len(lookups))))


def unique_candidate(rows: DataFrame, row_id: str, candidates: DataFrame, on: Sequence[str], candidate: str) -> DataFrame:
    """``row_id, candidate`` of rows for which exactly one candidate fits; the others have none.

    Candidates are counted, not gathered.
    """
    fits = rows.select(row_id, *on).join(candidates.select(*on, candidate), list(on)).select(row_id, candidate)
    one = fits.groupBy(row_id).agg(F.min(candidate).alias(candidate), F.max(candidate).alias("_m")).where(F.col(candidate) == F.col("_m"))
    return one.select(row_id, candidate)


def other_in_group(rows: DataFrame, group: str, ordinal: str, key: str) -> DataFrame:
    """Rows whose group has another row (another ordinal) with an equal key. Null keys equal nothing.

    By counting ordinals of each key, so a group's rows are not paired.
    """
    n = rows.where(F.col(key).isNotNull()).groupBy(group, key).agg(F.count_distinct(ordinal).alias("_n")).where("_n > 1").drop("_n")
    return rows.join(n, [group, key], "left_semi")


def missing_keys(expected: DataFrame, actual: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct expected keys (null-safe) that are not among the actual ones."""
    e, a = expected.select(*on).distinct().alias("e"), actual.select(*on).distinct().alias("a")
    return e.join(a, null_safe([F.col(f"e.{c}") for c in on], [F.col(f"a.{c}") for c in on]), "left_anti")


def exists_null_safe(rows: DataFrame, others: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows that have a partner with equal keys, where null equals null."""
    o = others.select(*(F.col(c).alias(f"_o_{c}") for c in on)).distinct()
    return rows.join(o, null_safe([F.col(c) for c in on], [F.col(f"_o_{c}") for c in on]), "left_semi")


def tiered_match(rows: DataFrame, row_id: str, targets: DataFrame, target: str, tiers: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """``row_id, target, tier``: each row's match by the first tier of keys that has one (its smallest target), else ``missing``."""
    left, found = rows, []
    for name, keys in tiers:
        t = targets.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))).groupBy(*keys).agg(F.min(target).alias(target))
        hit = left.join(t, list(keys)).groupBy(row_id).agg(F.min(target).alias(target))
        found.append(hit.select(row_id, target, F.lit(name).alias("tier")))
        left = left.join(hit, row_id, "left_anti")
    found.append(left.select(row_id, F.lit(None).cast(dict(targets.dtypes)[target]).alias(target), F.lit("missing").alias("tier")).distinct())
    return reduce(DataFrame.unionByName, found)


def queue_tiers(decisions: DataFrame, occurrences: DataFrame, group: str, decision: str, occurrence: str, tiers: Sequence[Sequence[str]]) -> DataFrame:
    """Pairs each decision with one occurrence of its group, tier by tier; what one tier used is gone for the next.

    Within a tier the k-th decision of a key takes the k-th occurrence in order of their ids.
    ``decision, occurrence, tier`` (from 1).
    """
    found = []
    d, o = decisions, occurrences
    for n, keys in enumerate(tiers, 1):
        cols = [group, *keys]
        wd, wo = Window.partitionBy(*cols).orderBy(decision), Window.partitionBy(*cols).orderBy(occurrence)
        a = d.select(*cols, decision, F.row_number().over(wd).alias("_k"))
        b = o.select(*cols, occurrence, F.row_number().over(wo).alias("_k"))
        hit = a.join(b, [*cols, "_k"]).select(decision, occurrence, F.lit(n).alias("tier"))
        found.append(hit)
        d, o = d.join(hit, decision, "left_anti"), o.join(hit, occurrence, "left_anti")
    return reduce(DataFrame.unionByName, found)


def variant_overlap(a: DataFrame, a_id: str, a_variants: str, b: DataFrame, b_id: str, b_variants: str) -> DataFrame:
    """Distinct ``a_id, b_id`` whose lists of variants have an entry in common."""
    x = a.select(a_id, F.explode(a_variants).alias("_v"))
    y = b.select(b_id, F.explode(b_variants).alias("_v"))
    return x.join(y, "_v").select(a_id, b_id).distinct()


def box_overlaps(boxes: DataFrame, page: str, ordinal: str, strip: float | None = None) -> DataFrame:
    """``page, a, b``: boxes (``x0, y0, x1, y1``) that overlap an earlier box of their page.

    For pages of very many boxes ``strip`` is the width of vertical strips: boxes meet only within a
    strip, and a pair counts in the first strip that both have.
    """
    keep = [page, ordinal, "x0", "y0", "x1", "y1"]
    c = F.col
    a, b = boxes.select(*keep), boxes.select(*keep)
    if strip is not None:
        cut = lambda x: F.floor(c(x) / strip)
        a, b = (t.withColumn("strip", F.explode(F.sequence(cut("x0"), F.greatest(cut("x0"), cut("x1"))))) for t in (a, b))
    a, b = a.alias("a"), b.alias("b")
    on = (
        (c(f"a.{page}") == c(f"b.{page}")) & (c(f"a.{ordinal}") < c(f"b.{ordinal}"))
        & (c("a.x0") < c("b.x1")) & (c("b.x0") < c("a.x1")) & (c("a.y0") < c("b.y1")) & (c("b.y0") < c("a.y1"))
    )
    if strip is not None:
        on &= (c("a.strip") == c("b.strip")) & (c("a.strip") == F.floor(F.greatest("a.x0", "b.x0") / strip))
    return a.join(b, on).select(c(f"a.{page}").alias(page), c(f"a.{ordinal}").alias("a"), c(f"b.{ordinal}").alias("b"))


def disagreeing(rows: DataFrame, on: str, row_id: str, text: str) -> DataFrame:
    """Pairs with an equal key whose texts do not contain one another; each pair once."""
    a, b = rows.alias("a"), rows.alias("b")
    c = F.col
    pairs = a.join(b, (c(f"a.{on}") == c(f"b.{on}")) & (c(f"a.{row_id}") < c(f"b.{row_id}")))
    apart = ~c(f"a.{text}").contains(c(f"b.{text}")) & ~c(f"b.{text}").contains(c(f"a.{text}"))
    return pairs.where(apart).select(c(f"a.{on}").alias(on), c(f"a.{row_id}").alias("a"), c(f"b.{row_id}").alias("b"))


def sweep(*axes: DataFrame) -> DataFrame:
    """All combinations of the values of a few parameters (their product is the wanted result)."""
    return reduce(lambda a, b: a.crossJoin(b), axes)


def overlay(values: DataFrame, slots: DataFrame, on: str, value: str) -> DataFrame:
    """Values laid over the slots of the same name; the rest is reported.

    ``slots``: ``on, node, field, is_link``. Result: ``on, node, field, value, status`` with status
    ``set``, ``unknown`` (no such slot), ``missing_node`` or ``link`` (the slot is fed by a link).
    """
    s = slots.select(F.col(on).alias("_on"), "node", "field", "is_link")
    out = values.select(on, F.col(value).alias("value")).join(s, F.col(on) == F.col("_on"), "left")
    status = F.when(F.col("_on").isNull(), "unknown").when(F.col("node").isNull(), "missing_node").when(F.coalesce("is_link", F.lit(False)), "link").otherwise("set")
    return out.select(on, "node", "field", "value", status.alias("status"))


def similar_pairs(rows: DataFrame, others: DataFrame, block: Sequence[str], a: str, b: str, least: float, within: Column | None = None) -> DataFrame:
    """Pairs of one block whose texts ``a`` and ``b`` are similar to at least ``least`` (Ratcliff-Obershelp).

    A pair whose lengths alone forbid the similarity never reaches Python.
    """
    from stemma.functions.unicode import ratio

    pairs = rows.join(others, list(block))
    if within is not None:
        pairs = pairs.where(within)
    la, lb = F.length(a), F.length(b)
    possible = 2 * F.least(la, lb) >= least * (la + lb)
    rated = pairs.where(possible).withColumn("similarity", ratio(F.col(a), F.col(b)))
    return rated.where(F.col("similarity") >= least)


def similar_titles(rows: DataFrame, node: str, title: str, year: str, least: float = 0.85, window: int = 2) -> DataFrame:
    """``node, other, similarity`` of classes within ``window`` years whose normalised titles are similar.

    Rows of equal title and year are one class, named by its smallest id (see ``title_classes``), and
    are not paired with each other. Two titles meet by a word among the rarer half of either's words,
    so that common words bring nothing together; titles that share none of these are not compared. A
    null title or year is similar to nothing.
    """
    from stemma.functions.unicode import GRAM_WORDS, gram_bits, ratio_from

    spark = rows.sparkSession
    dated = rows.where(F.col(title).isNotNull() & F.col(year).isNotNull()).select(F.col(node).alias("id"), F.col(title).alias("t"), F.col(year).cast("bigint").alias("y"))
    bits = [f"m{k}" for k in range(GRAM_WORDS)]
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    with Scratch(spark) as tables:
        classes = dated.groupBy("t", "y").agg(F.min("id").alias("c"))
        # a title has at most as many classes as there are years; titles and words have numbers, since texts are long
        texts = tables.written(classes.groupBy("t").agg(F.collect_list(F.struct("y", "c")).alias("classes")).withColumn("i", F.monotonically_increasing_id()), "texts")
        words = texts.select("i", F.explode(F.array_distinct(F.split("t", " "))).alias("w"))
        often = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
        # the numbers of words rise with how often they are
        order = tables.written(often.orderBy("n", "w").select("w", F.monotonically_increasing_id().alias("k")), "order")
        # a title has few words
        ranked = words.join(order, "w").groupBy("i").agg(F.array_sort(F.collect_list("k")).alias("ks"))
        rare = ranked.select("i", F.slice("ks", F.lit(1), (F.floor(F.size("ks") / 2) + 1).cast("int")).alias("ks"))
        marked = spread(texts.join(rare, "i").select("i", "t", F.col("classes.y").alias("ys"), "ks")).withColumn("m", gram_bits("t"))
        titles = tables.written(marked.select("i", "t", "ys", "ks", F.length("t").alias("n"), "m.*"), "titles")
        meetings = titles.agg(F.sum(F.size("ks") * F.size("ys"))).first()[0] or 0  # one number
        shares = max(1, -(-meetings // WORDS_A_ROUND))
        # a row meets those of its own and the next years, in spans of several years, so that few rows are in two
        span = lambda y: F.floor(y / (2 * window + 1))
        # the similarity is at most twice the shorter length by both lengths
        both = F.col("na") + F.col("nb")
        fits = F.when(F.col("ya") == F.col("yb"), F.col("ia") < F.col("ib")).otherwise((F.col("ia") != F.col("ib")) & (F.col("yb") - F.col("ya")).between(1, window)) & (2 * F.least("na", "nb") >= least * both)
        # so many letters match, in blocks with an unmatched letter between any two: so many pairs of neighbours are in both
        match = F.ceil(least * both / 2 - 1e-6)
        shared = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"{c}a").bitwiseAND(F.col(f"{c}b"))) for c in bits))
        fits &= shared + F.least("sparea", "spareb") >= 3 * match - both - 1
        # once, by the rarest word that both have
        fits &= F.array_min(F.array_intersect("ksa", "ksb")) == F.col("k")

        def alike(nth: int) -> DataFrame:
            """Numbers and similarity of the titles that meet by a word of this share."""
            own = F.filter("ks", lambda k: F.pmod(k, F.lit(shares)) == nth)
            met = titles.where(F.size(own) > 0).withColumn("k", F.explode(own)).withColumn("y", F.explode("ys"))
            side = lambda x: [F.col(c).alias(f"{c}{x}") for c in ("i", "t", "y", "n", "ks", "spare", *bits)]
            a = met.select(*side("a"), "k", F.explode(F.sequence(span(F.col("y")), span(F.col("y") + window))).alias("span"))
            b = met.select(*side("b"), "k", span(F.col("y")).alias("span"))
            # few bytes and much work: partitions of this number are not coalesced
            near = a.repartition(tasks, "k", "span").join(b.repartition(tasks, "k", "span"), ["k", "span"]).where(fits)
            # a pair is rated where it meets, so that no pair is shuffled; else the rating would be asked for twice
            rated = ratio_from(least).asNondeterministic()(F.least("ta", "tb"), F.greatest("ta", "tb"))
            return near.select(F.least("ia", "ib").alias("ia"), F.greatest("ia", "ib").alias("ib"), rated.alias("s")).where(F.col("s") >= least)

        found = [tables.written(alike(nth), "alike") for nth in range(shares)]
        return written(_title_pairs(texts, reduce(DataFrame.unionByName, found).distinct(), node, window), "similar")


def _title_pairs(texts: DataFrame, alike: DataFrame, node: str, window: int) -> DataFrame:
    """Classes of the similar titles ``ia, ib, s``, and those of one title in several years."""
    of = lambda x: texts.select(F.col("i").alias(f"i{x}"), F.explode("classes").alias(x)).select(f"i{x}", f"{x}.y", f"{x}.c").toDF(f"i{x}", f"y{x}", f"c{x}")
    in_time = F.abs(F.col("ya") - F.col("yb")) <= window
    differ = alike.join(of("a"), "ia").join(of("b"), "ib").where(in_time).select("ca", "cb", "s")
    several = texts.where(F.size("classes") > 1).select("classes", F.explode("classes").alias("a")).select("a", F.explode("classes").alias("b"))
    several = several.select(F.col("a.y").alias("ya"), F.col("a.c").alias("ca"), F.col("b.y").alias("yb"), F.col("b.c").alias("cb"))
    same = several.where(in_time & (F.col("ca") < F.col("cb"))).select("ca", "cb", F.lit(1.0).alias("s"))
    both = differ.unionByName(same)
    return both.select(F.least("ca", "cb").alias(node), F.greatest("ca", "cb").alias("other"), F.round("s", 4).alias("similarity"))


def title_classes(rows: DataFrame, node: str, title: str, year: str) -> DataFrame:
    """``node, class``: rows of equal title and year share a class, its smallest id; without either a row is its own."""
    c = rows.groupBy(F.col(title).alias("_t"), F.col(year).alias("_y")).agg(F.min(node).alias("class"))
    own = rows.join(c, (F.col(title) == F.col("_t")) & (F.col(year) == F.col("_y")), "left")
    return own.select(node, F.coalesce("class", F.col(node)).alias("class"))
