"""Projections of landed records, and the sets, orders and groups that are taken of them."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.functions import text as X
from stemma.operators.filters import assembled
from stemma.operators.ordered import numbered


def projected(records: DataFrame, columns: Mapping[str, str | Column], required: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Columns under new names, text without outer white space and blanks as nulls.

    ``columns``: new name to old name (of a text) or to an expression, which is taken as it is.
    Records without one of the ``required`` (new names) are dropped.
    """
    out = records.select(*keep, *(X.clean_string(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in columns.items()))
    for n in required:
        out = out.where(F.col(n).isNotNull())
    return out


def joined_parts(separator: str, *parts: Column | str) -> Column:
    """Non-blank parts joined; an empty text without any, as of a telephone number."""
    return F.concat_ws(separator, *(X.clean_string(p) for p in parts))


def struct_list(items: Column, fields: Mapping[str, str]) -> Column:
    """Array of structs with new field names and cleaned texts. Null elements fall away, a null array is empty."""
    one = lambda x: F.struct(*(X.clean_string(x[old]).alias(new) for new, old in fields.items()))
    return F.transform(F.filter(F.coalesce(items, F.array()), lambda x: x.isNotNull()), one)


def author_list(items: Column, first: str = "first", middle: str = "middle", last: str = "last", ref: str = "ref") -> Column:
    """Array of ``position, name, ref``: the name is put together from its parts, else it is the reference.

    Positions count from 1 and count null elements too, which fall away.
    """

    def one(x: Column, i: Column) -> Column:
        own = X.clean_string(x[ref])
        return F.when(x.isNotNull(), F.struct((i + 1).alias("position"), F.coalesce(assembled(x[first], x[middle], x[last]), own).alias("name"), own.alias("ref")))

    return F.filter(F.transform(F.coalesce(items, F.array()), one), lambda x: x.isNotNull())


def flagged(rows: DataFrame, key: str, members: DataFrame, flag: str = "is_member") -> DataFrame:
    """``rows`` with ``flag``: whether ``key`` is among the values of ``members`` (one column). A null key is not."""
    m = members.select(F.col(members.columns[0]).alias("_m")).where("_m is not null").distinct()
    return rows.join(m, F.col(key) == F.col("_m"), "left").withColumn(flag, F.col("_m").isNotNull()).drop("_m")


def row_indices(rows: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """``keys, ordinal, n``: the rows of groups of more than one row. A null key is a group.

    One row a member, so that no group, however large, is collected.
    """
    sizes = rows.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.select(*keys, ordinal).join(sizes, on).select(*keys, ordinal, "n")


def occurrences(rows: DataFrame, keys: Sequence[str], order: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keys, occurrence, is_first``, ``order`` and ``keep``: every row of a link with its place among the link's rows."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return rows.select(*keys, order, *keep, place.alias("occurrence")).withColumn("is_first", F.col("occurrence") == 1)


def group_least(rows: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """The least value of each group, such as the left edge of a page's columns."""
    return rows.groupBy(*keys).agg(F.min(value).alias(name))


def by_name(rows: DataFrame, name: str, order: str) -> DataFrame:
    """``rows`` with ``place`` in the order of names whatever their case; equal names stay in the order of ``order``. Null names go first."""
    return numbered(rows.withColumn("_n", F.lower(name)), ["_n", order], "place").drop("_n")


def reading_order(boxes: DataFrame, page: str, column: str, top: str, left: str) -> DataFrame:
    """``boxes`` with ``place``: by page, column, from top to bottom, from left to right."""
    return numbered(boxes, [page, column, top, left], "place")


def all_values(*columns: tuple[DataFrame, str], name: str = "value") -> DataFrame:
    """Each non-null value of several columns once."""
    out = None
    for df, c in columns:
        one = df.select(F.col(c).alias(name)).where(F.col(name).isNotNull())
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def in_range(at: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """Whether a time lies in a range, both ends included: by default from now for seven days. A null time does not."""
    start = F.current_timestamp() if start is None else start
    end = start + F.expr("interval 7 days") if end is None else end
    return F.coalesce(at.between(start, end), F.lit(False))


def orphaned(tasks: DataFrame, state: Column, terminal: Sequence[str], owner: str, owners: DataFrame) -> DataFrame:
    """Tasks that are not in a terminal state and whose owner is none of ``owners`` (one column). A task without an owner is one."""
    o = owners.select(F.col(owners.columns[0]).alias("_o")).distinct()
    return tasks.where(~F.coalesce(state.isin(*terminal), F.lit(False))).join(o, F.col(owner) == F.col("_o"), "left_anti")


def _links_in(value: object) -> Iterator[tuple[str, str | None]]:
    if isinstance(value, dict):
        url = value.get("url")
        if isinstance(url, str) and url.strip():
            title = value.get("title")
            yield url.strip(), title if isinstance(title, str) else None
        for v in value.values():
            yield from _links_in(v)
    elif isinstance(value, list):
        for v in value:
            yield from _links_in(v)


def harvested(records: DataFrame, key: str, body: str) -> DataFrame:
    """``key, place, url, title``: every object with a ``url`` anywhere in a JSON text, in document order.

    Of URLs with one normal form (see ``url_key``) a record has the first. Text that is no JSON, and null, has none.
    """
    kind = dict(records.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, place, urls, titles = [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                try:
                    found = list(_links_in(json.loads(t))) if t else []
                except ValueError:
                    found = []
                for n, (u, title) in enumerate(found, 1):
                    at.append(i)
                    place.append(n)
                    urls.append(u)
                    titles.append(title)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(place, pa.int32()), pa.array(urls, pa.string()), pa.array(titles, pa.string())], [key, "n", "url", "title"])

    flat = records.select(key, body).mapInArrow(run, f"`{key}` {kind}, n int, url string, title string")
    first = flat.groupBy(key, X.url_key("url").alias("url")).agg(F.min(F.struct("n", "title")).alias("f"))
    from pyspark.sql import Window

    return first.select(key, F.row_number().over(Window.partitionBy(key).orderBy("f.n")).alias("place"), "url", "f.title")
