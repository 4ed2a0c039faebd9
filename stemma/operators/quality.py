"""Profiles, counts and set checks. A check gives rows, so that it can be stored and compared."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.functions.text import has_content
from stemma.operators.joins import null_safe


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``field, present, missing, percent`` (one decimal) of each column, in one pass.

    A blank string and an empty list are missing. An empty table gives 0 percent.
    """
    kinds = dict(df.dtypes)
    columns = list(columns or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"), *(F.count_if(has_content(c, kinds[c])).alias(f"_{i}") for i, c in enumerate(columns)))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"_{i}").alias("present")) for i, c in enumerate(columns))))
    out = one.select("_n", rows.alias("x")).select("x.field", "x.present", (F.col("_n") - F.col("x.present")).alias("missing"), "_n")
    return out.select("field", "present", "missing", F.when(F.col("_n") > 0, F.round(100.0 * F.col("present") / F.col("_n"), 1)).otherwise(F.lit(0.0)).alias("percent"))


def frequency(df: DataFrame, *by: Column | str) -> DataFrame:
    """Rows of each value, most first, equal numbers by value."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n`` of each table."""
    return reduce(DataFrame.unionByName, (t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, t in tables.items()))


def changed_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tables whose number of rows differs between two ``table_counts``."""
    a, b = before.withColumnRenamed("n", "n_before"), after.withColumnRenamed("n", "n_after")
    return a.join(b, "table_name", "full_outer").where(~F.col("n_before").eqNullSafe(F.col("n_after")))


def difference(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of only one side: ``on, side`` (``missing``: not in b; ``extra``: not in a). No rows: the sets are equal."""
    x, y = a.select(*on).distinct(), b.select(*on).distinct()

    def only(p: DataFrame, q: DataFrame, name: str) -> DataFrame:
        p, q = p.alias("p"), q.alias("q")
        cond = null_safe([F.col(f"p.{c}") for c in on], [F.col(f"q.{c}") for c in on])
        return p.join(q, cond, "left_anti").withColumn("side", F.lit(name))

    return only(x, y, "missing").unionByName(only(y, x, "extra"))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups of more than one row: ``keys, n, surplus``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("surplus", F.col("n") - 1)


def inventory(expected: DataFrame, seen: DataFrame, key: str, state: str, states: dict[str, Sequence[str]]) -> DataFrame:
    """``key, class`` of each expected key by the state of its row in ``seen``: ``missing`` without one, ``unknown`` for a state that no class lists."""
    s = seen.select(F.col(key).alias("_k"), F.lower(F.trim(state)).alias("_s"))
    kind = F.lit("unknown")
    for name, values in states.items():
        kind = F.when(F.col("_s").isin(*values), F.lit(name)).otherwise(kind)
    return expected.select(key).distinct().join(s, F.col(key) == F.col("_k"), "left").select(key, F.when(F.col("_k").isNull(), "missing").otherwise(kind).alias("class"))


def checked(name: str, bad: DataFrame) -> DataFrame:
    """One row ``check_name, ok, n_bad`` from the rows that break a rule."""
    return bad.agg(F.count(F.lit(1)).alias("n_bad")).select(F.lit(name).alias("check_name"), (F.col("n_bad") == 0).alias("ok"), "n_bad")


def first_reason(rules: Sequence[tuple[str, Column]], otherwise: str | None = None) -> Column:
    """Name of the first rule that holds; the order of the rules counts."""
    c = F.lit(otherwise)
    for name, rule in reversed(rules):
        c = F.when(rule, F.lit(name)).otherwise(c)
    return c


def warnings(rules: Sequence[tuple[str, Column]]) -> Column:
    """List of the names of all rules that hold."""
    return F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules)))


def any_content(fields: Sequence[tuple[str, str]]) -> Column:
    """Whether any of the fields ``(path, type)`` of a nested record has content."""
    return reduce(lambda a, b: a | b, (has_content(p, kind) for p, kind in fields))


class Violation(ValueError):
    """A table breaks a rule that the step behind it relies on."""


def must_be_empty(rows: DataFrame, rule: str, shown: int = 5) -> None:
    """Stop with the rule and the first few rows that break it; nothing if there are none."""
    bad = rows.limit(shown).collect()
    if bad:
        raise Violation(f"{rule}: {[r.asDict() for r in bad]}")


def unique_index(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, of which no two rows may have the same keys."""
    must_be_empty(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"doubled {', '.join(keys)}")
    return df


def known_states(df: DataFrame, state: Column, allowed: list[str]) -> DataFrame:
    """``df``, whose states must be among those allowed; an absent one is not."""
    must_be_empty(df.select(state.alias("state")).where(~F.coalesce(F.col("state").isin(*allowed), F.lit(False))).distinct(), "unknown state")
    return df


def unchanged(before: DataFrame, after: DataFrame) -> None:
    """Counts (``table_name, n``) that must be the same before and after."""
    must_be_empty(changed_counts(before, after), "changed counts")
