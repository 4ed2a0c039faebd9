"""Normalisers and parsers as Column expressions: they stay in the JVM and in code generation.

White space means Unicode white space where the pattern starts with ``(?U)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_string(c: Column | str) -> Column:
    """Stripped of Unicode white space; null if nothing is left."""
    return F.nullif(F.regexp_replace(col(c), r"(?U)^\s+|\s+$", ""), F.lit(""))


def collapsed(c: Column | str) -> Column:
    """Stripped, with runs of white space made one space; null if nothing is left."""
    return clean_string(F.regexp_replace(col(c), r"(?U)\s+", " "))


def title_key(c: Column | str) -> Column:
    """Small letters and digits of ASCII; quotes and apostrophes vanish, all else parts words."""
    s = F.regexp_replace(F.lower(col(c)), "['\"’‘“”`]", "")
    return collapsed(F.regexp_replace(s, r"[^a-z0-9]+", " "))


def title_key_apart(c: Column | str) -> Column:
    """As ``title_key``, but an apostrophe parts words too."""
    return collapsed(F.regexp_replace(F.lower(col(c)), r"[^a-z0-9]+", " "))


def name_key_ascii(c: Column | str) -> Column:
    """Small ASCII letters of a name; every other character, marked letters included, parts words."""
    return collapsed(F.regexp_replace(F.lower(col(c)), r"[^a-z0-9]+", " "))


def folded(c: Column | str) -> Column:
    """Case-insensitive key: stripped, single spaces, lower case."""
    return F.lower(collapsed(c))


def doi_bare(c: Column | str) -> Column:
    """DOI without scheme, host or ``doi:`` prefix, in lower case; no validation."""
    s = F.regexp_replace(F.lower(clean_string(c)), r"^(?:https?://[^/]*/|doi:?\s*)+", "")
    return clean_string(s)


def doi(c: Column | str) -> Column:
    """The DOI that stands anywhere in the cell, in lower case without closing punctuation; null without one."""
    found = F.regexp_extract(F.lower(col(c)), r"10\.[0-9]{4,9}/[^\s\"<>]+", 0)
    return F.nullif(F.regexp_replace(found, r"[.,;]+$", ""), F.lit(""))


def recovered_doi(*fields: Column | str) -> Column:
    """First DOI among several cells."""
    return F.coalesce(*(doi(f) for f in fields))


def recovered_from(names: Sequence[str]) -> Column:
    """Name of the cell whose DOI ``recovered_doi`` takes; null if none has one."""
    c = F.lit(None).cast("string")
    for n in reversed(names):
        c = F.when(doi(n).isNotNull(), F.lit(n)).otherwise(c)
    return c


def year(*fields: Column | str) -> Column:
    """First year of the 20th or 21st century that stands as a word in one of the cells."""
    return F.coalesce(*(F.nullif(F.regexp_extract(col(f).cast("string"), r"\b((?:19|20)[0-9]{2})\b", 1), F.lit("")) for f in fields)).try_cast("int")


def year_int(c: Column | str) -> Column:
    """The cell as a whole number, else null."""
    return F.trim(col(c).cast("string")).try_cast("int")


def boolean(c: Column | str) -> Column:
    s = folded(col(c).cast("string"))
    return F.when(s.isin("true", "yes", "y", "1", "t"), True).when(s.isin("false", "no", "n", "0", "f"), False)


def safe_int(c: Column | str) -> Column:
    return F.trim(col(c).cast("string")).try_cast("int")


def first_nonempty(*fields: Column | str) -> Column:
    """First cell that is neither null nor blank."""
    return F.coalesce(*(clean_string(f) for f in fields))


def falsy(c: Column | str, kind: str) -> Column:
    """Whether a cell of the type counts as missing where 0, false and empty lists do too."""
    c = col(c)
    if kind.startswith(("array", "map")):
        return c.isNull() | (F.size(c) <= 0)
    if kind == "boolean":
        return c.isNull() | ~c
    if kind == "string":
        return c.isNull() | (c == "")
    return c.isNull() | (c == 0)


def has_content(c: Column | str, kind: str) -> Column:
    """A string with more than white space, a list or map with entries, any other value that is not null."""
    c = col(c)
    if kind.startswith(("array", "map")):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return clean_string(c).isNotNull() if kind == "string" else c.isNotNull()


def is_url(c: Column | str) -> Column:
    return F.coalesce(col(c).rlike(r"(?i)^\s*https?://"), F.lit(False))


def is_full_url(c: Column | str) -> Column:
    """A URL with scheme and host."""
    return F.coalesce(col(c).rlike(r"(?i)^\s*https?://[^/\s?#]+"), F.lit(False))


def clean_url(c: Column | str) -> Column:
    return F.when(is_url(c), clean_string(c))


def url_key(c: Column | str) -> Column:
    """Without fragment and closing slash; the query stays."""
    return F.regexp_replace(F.regexp_replace(clean_string(c), r"#.*$", ""), r"/+$", "")


def name_parts(c: Column | str) -> Column:
    """Struct ``first, last, initials`` of a normalised name; a single part is both first and last."""
    w = F.split(col(c), " ")
    return F.struct(
        F.element_at(w, 1).alias("first"),
        F.element_at(w, -1).alias("last"),
        F.array_join(F.transform(w, lambda x: F.substring(x, 1, 1)), "").alias("initials"),
    )


def rank_of(c: Column | str, order: Sequence[str]) -> Column:
    """Place of the state in the list, from 1; 0 for any other."""
    s = folded(c)
    r = F.lit(0)
    for i, name in enumerate(order, 1):
        r = F.when(s == name, F.lit(i)).otherwise(r)
    return r


def without_tags(c: Column | str) -> Column:
    """Mark-up made spaces, the common entities undone, white space collapsed."""
    s = F.regexp_replace(col(c), r"<[^>]*>", " ")
    # The entities of XML and the hard space.
    for entity, plain in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(entity), F.lit(plain))
    return collapsed(s)


def moment(c: Column | str) -> Column:
    """Timestamp of an RFC 822 or ISO 8601 text; null if it is neither."""
    bare = F.regexp_replace(clean_string(c), r"^[A-Za-z]{3},?\s+", "")
    zone = F.regexp_replace(bare, r"\b(?:GMT|UTC|UT|Z)$", "+0000")
    tries = [F.try_to_timestamp(zone, F.lit(p)) for p in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm:ss", "d MMM yyyy")]
    return F.coalesce(*tries, F.try_to_timestamp(clean_string(c)))


def iso_moment(c: Column | str) -> Column:
    """The moment as UTC text; the raw text where it cannot be read."""
    return F.coalesce(F.date_format(moment(c), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), clean_string(c))


def sentences(c: Column | str, least_words: int = 4) -> Column:
    """Sentences of at least so many words; headings, quotes and table lines are none."""
    lines = F.filter(F.split(col(c), r"\n"), lambda x: ~x.rlike(r"^\s*(#|\||>)"))
    text = F.array_join(lines, " ")
    parts = F.transform(F.split(text, r"(?<=[.!?])\s+"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: F.size(F.split(x, r"\s+")) >= least_words)


def citation_ids(c: Column | str) -> Column:
    """All numbers cited as ``[n]``, in order."""
    return F.transform(F.regexp_extract_all(col(c), F.lit(r"\[([0-9]+)\]"), F.lit(1)), lambda x: x.try_cast("int"))


def links(c: Column | str) -> Column:
    """Targets of ``[[wiki]]`` links, without alias and section."""
    return F.transform(F.regexp_extract_all(col(c), F.lit(r"\[\[([^\]|#]+)"), F.lit(1)), lambda x: F.trim(x))


def html_links(c: Column | str, kind: str = r"rss|atom|feed|json") -> Column:
    """Targets of ``<link>`` elements whose type names a feed."""
    tags = F.filter(F.regexp_extract_all(col(c), F.lit(r"(?i)(<link\b[^>]*>)"), F.lit(1)), lambda x: x.rlike(rf"(?i)type\s*=\s*[\"'][^\"']*(?:{kind})"))
    return F.filter(F.transform(tags, lambda x: F.regexp_extract(x, r"(?i)href\s*=\s*[\"']([^\"']+)", 1)), lambda x: x != "")


def feed_kind(c: Column | str) -> Column:
    """``json``, ``xml``, ``html`` or null by the beginning of the text."""
    s = F.lower(F.ltrim(F.substring(col(c), 1, 500)))
    return F.when(s.startswith("{"), "json").when(s.rlike(r"^(<\?xml[^>]*>\s*)?<(rss|feed|rdf)"), "xml").when(s.rlike("^<(!doctype html|html)"), "html")


def duration_text(seconds: Column | str) -> Column:
    s = col(seconds).cast("bigint")
    h, m = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60)
    return F.when(h > 0, F.format_string("%dh %dmin", h, m)).when(m > 0, F.format_string("%d min", m)).otherwise(F.format_string("%d s", s))


def distance_text(metres: Column | str) -> Column:
    m = col(metres)
    return F.when(m >= 1000, F.format_string("%.1f km", m / 1000)).otherwise(F.format_string("%d m", F.round(m).cast("bigint")))


def clock_text(seconds: Column | str) -> Column:
    s = col(seconds).cast("bigint")
    h = F.floor(s / 3600)
    rest = F.format_string("%02d:%02d", F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))
    return F.when(h > 0, F.concat(h.cast("string"), F.lit(":"), rest)).otherwise(F.regexp_replace(rest, "^0", ""))


def video_id(c: Column | str) -> Column:
    """The 11 characters that name a video, alone or in one of the usual URLs."""
    in_url = F.regexp_extract(col(c), r"(?:v=|youtu\.be/|/shorts/|/embed/|/live/)([A-Za-z0-9_-]{11})", 1)
    alone = F.regexp_extract(F.trim(col(c)), r"^([A-Za-z0-9_-]{11})$", 1)
    return F.coalesce(F.nullif(in_url, F.lit("")), F.nullif(alone, F.lit("")))


def file_name(*parts: Column | str, suffix: str = ".pdf") -> Column:
    """Parts without characters that file systems mind, joined by underscores."""
    clean = [F.nullif(F.regexp_replace(F.regexp_replace(col(p).cast("string"), r"[^A-Za-z0-9]+", "_"), r"^_+|_+$", ""), F.lit("")) for p in parts]
    return F.concat(F.concat_ws("_", *clean), F.lit(suffix))


def page_numbers(spec: Column | str, last: Column | int) -> Column:
    """Pages of ``1-3,5,9-`` in order, an open end running to ``last``; null if a part cannot be read or lies outside."""
    last = F.lit(last) if isinstance(last, int) else last
    parts = F.transform(F.split(F.regexp_replace(col(spec), r"\s", ""), ","), lambda p: p)
    good = F.forall(parts, lambda p: p.rlike(r"^[0-9]+(-[0-9]*)?$"))
    start = lambda p: F.regexp_extract(p, r"^([0-9]+)", 1).try_cast("int")

    def stop(p: Column) -> Column:
        return F.when(~p.contains("-"), start(p)).otherwise(F.coalesce(F.nullif(F.regexp_extract(p, r"-([0-9]+)$", 1), F.lit("")).try_cast("int"), last))

    inside = F.forall(parts, lambda p: (start(p) >= 1) & (stop(p) <= last) & (start(p) <= stop(p)))
    return F.when(good & F.coalesce(inside, F.lit(False)), F.flatten(F.transform(parts, lambda p: F.sequence(start(p), stop(p)))))


def zero_filled(c: Column | str, width: int = 8) -> Column:
    """Left-filled with zeros, never cut: ids so sort by number."""
    return F.lpad(col(c), F.greatest(F.lit(width), F.length(col(c))), F.lit("0"))


def coerced(c: Column | str) -> Column:
    """Kind of a cell: ``bool, int, float, date, datetime, string`` or null."""
    s = F.trim(col(c).cast("string"))
    return (
        F.when(s.isNull() | (s == ""), F.lit(None))
        .when(F.lower(s).isin("true", "false"), "bool")
        .when(s.rlike(r"^[+-]?[0-9]{1,18}$"), "int")
        .when(s.rlike(r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+|[0-9]+)([eE][+-]?[0-9]+)?$"), "float")
        .when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & s.try_cast("date").isNotNull(), "date")
        .when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}") & F.try_to_timestamp(s).isNotNull(), "datetime")
        .otherwise("string")
    )


def cell_text(value: Column | str) -> Column:
    """Text of a timestamp cell: midnight is written as a date."""
    v = col(value)
    return F.when(F.date_format(v, "HH:mm:ss.SSSSSS") == "00:00:00.000000", F.date_format(v, "yyyy-MM-dd")).otherwise(F.date_format(v, "yyyy-MM-dd'T'HH:mm:ss"))


def match_key(c: Column | str) -> Column:
    """Words of a quotation without Markdown marks, quotes and case, for verbatim containment."""
    s = F.regexp_replace(F.lower(col(c)), r"[*_`#>\[\]\"'“”‘’]", "")
    return collapsed(s)


def quoted_in(quote: Column | str, text: Column | str, least_words: int = 3) -> Column:
    """Whether the quotation, of at least so many words, stands in the text."""
    q = match_key(quote)
    return F.coalesce((F.size(F.split(q, " ")) >= least_words) & match_key(text).contains(q), F.lit(False))
