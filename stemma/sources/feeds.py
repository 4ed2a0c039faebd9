"""RSS, RDF, Atom and JSON feeds that were landed as text: ``title, link, published, author, summary``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.functions import text as X

ENTRY = ("title", "link", "published", "author", "summary")


def _tag(item: Column, *names: str) -> Column:
    """Text of the first of the elements that is not blank, CDATA undone."""
    found = [F.nullif(F.trim(F.regexp_extract(item, rf"(?s)<(?:\w+:)?{n}(?:\s[^>]*)?>(.*?)</(?:\w+:)?{n}>", 1)), F.lit("")) for n in names]
    return F.regexp_replace(F.coalesce(*found), r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1")


def xml_entries(feeds: DataFrame, keep: tuple[str, ...] = ("file",), most: int = 2000) -> DataFrame:
    """Entries of RSS 2.0, RDF and Atom texts (``body``); summaries are plain text of at most ``most`` characters."""
    items = F.explode(F.regexp_extract_all("body", F.lit(r"(?s)(<(?:item|entry)[\s>].*?</(?:item|entry)>)"), F.lit(1)))
    e = feeds.select(*keep, items.alias("e"))
    i = F.col("e")
    href = F.coalesce(
        F.nullif(F.regexp_extract(i, r"""<link\b(?=[^>]*rel=["']alternate["'])[^>]*href=["']([^"']+)["']""", 1), F.lit("")),
        F.nullif(F.regexp_extract(i, r"""<link\b[^>]*href=["']([^"']+)["']""", 1), F.lit("")),
    )
    author = F.coalesce(_tag(i, "name"), _tag(i, "author", "creator"))
    return e.select(
        *keep,
        X.without_tags(_tag(i, "title")).alias("title"),
        F.coalesce(X.clean_string(_tag(i, "link")), href).alias("link"),
        X.iso_moment(_tag(i, "pubDate", "published", "updated", "date")).alias("published"),
        X.without_tags(author).alias("author"),
        F.left(X.without_tags(_tag(i, "description", "summary", "content")), F.lit(most)).alias("summary"),
    )


_JSON = "struct<items: array<struct<title: string, url: string, id: string, date_published: string, date_modified: string, author: struct<name: string>, authors: array<struct<name: string>>, summary: string, content_text: string, content_html: string>>>"


def json_entries(feeds: DataFrame, keep: tuple[str, ...] = ("file",), most: int = 2000) -> DataFrame:
    """Entries of JSON feeds (``body``)."""
    e = feeds.select(*keep, F.explode(F.from_json("body", _JSON)["items"]).alias("e"))
    return e.select(
        *keep,
        X.clean_string("e.title").alias("title"),
        X.first_nonempty("e.url", "e.id").alias("link"),
        X.iso_moment(X.first_nonempty("e.date_published", "e.date_modified")).alias("published"),
        F.coalesce(F.col("e.author.name"), F.get("e.authors.name", 0)).alias("author"),
        F.left(X.without_tags(X.first_nonempty("e.summary", "e.content_text", "e.content_html")), F.lit(most)).alias("summary"),
    )


def entries(feeds: DataFrame, keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """Entries of landed feeds of any kind; what is no feed has none."""
    kind = X.feed_kind("body")
    return xml_entries(feeds.where(kind == "xml"), keep).unionByName(json_entries(feeds.where(kind == "json"), keep))


def since(entries_: DataFrame, when: str | None, most: int | None = None) -> DataFrame:
    """Newest first; with ``when`` only later entries, and none without a date."""
    out = entries_ if when is None else entries_.where(F.col("published") > when)
    out = out.orderBy(F.desc_nulls_last("published"), "link")
    return out.limit(most) if most is not None else out


def discovered(pages: DataFrame) -> DataFrame:
    """``page, feed`` for each page (``page, html``): the feeds that its head names, as whole URLs."""
    from stemma.functions.unicode import joined_url

    return pages.select("page", F.explode(X.html_links("html")).alias("link")).select("page", joined_url("page", "link").alias("feed"))


def recovered(attempts: DataFrame, least: int = 500) -> DataFrame:
    """``url, route, ok`` of the first usable answer for each URL (``url, place, route, title, body``).

    An answer is usable if it is long enough and its title tells of no block or error.
    """
    refused = F.coalesce(F.col("title").rlike(r"(?i)(access denied|attention required|just a moment|are you a robot|captcha|forbidden|not found|error \d{3})"), F.lit(False))
    ok = (F.length(F.trim("body")) >= least) & ~refused
    a = attempts.withColumn("ok", F.coalesce(ok, F.lit(False)))
    best = a.groupBy("url").agg(F.min_by(F.struct("route", "ok"), F.struct(~F.col("ok"), F.col("place"))).alias("b"))
    return best.select("url", "b.route", "b.ok")
