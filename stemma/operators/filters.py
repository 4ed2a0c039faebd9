"""Predicates put together from parts, and record assembly."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stemma.functions.text import clean_string


def all_of(conditions: Sequence[Column | None]) -> Column:
    """All given conditions; those that are None were not asked for. No condition: everything."""
    return reduce(lambda a, b: a & b, (c for c in conditions if c is not None), F.lit(True))


def assembled(*parts: Column | str) -> Column:
    """Non-blank parts joined by spaces; null without any."""
    return F.nullif(F.concat_ws(" ", *(clean_string(p) for p in parts)), F.lit(""))


def ordered_union(*lists: Column) -> Column:
    """Entries of several lists in order, each once."""
    return F.array_distinct(F.concat(*(F.coalesce(x, F.array()) for x in lists)))


def promoted(tags: Column, keys: Sequence[str]) -> tuple[list[Column], Column]:
    """Columns for some keys of a map, and the map of the rest."""
    return [F.try_element_at(tags, F.lit(k)).alias(k) for k in keys], F.map_filter(tags, lambda k, _: ~k.isin(*keys))


def point(lat: Column, lon: Column, centre: Column) -> Column:
    """Own coordinates, else those of the centre (struct ``lat, lon``)."""
    return F.struct(F.coalesce(lat, centre["lat"]).alias("lat"), F.coalesce(lon, centre["lon"]).alias("lon"))
