"""Copies hidden by formatting differences, and the best values of each group of copies.

Two records are copies when their years are equal (or absent from both) and their titles have the
same letters and digits in the same order as a reader sees them. The canonical text is hashed; a
pair of Bloom filters (hashes seen once, hashes seen repeatedly) is built in each partition and
merged by ``(a1, a2) + (b1, b2) = (a1|b1, a2|b2|(a1&b1))``, which never loses a repeated hash. Only
rows that the merged filter calls possible repeats are shuffled and grouped exactly; all others are
emitted as groups of one where they stand.

The filter has 16 to 32 bits a key whatever their number. It is cut by the hash's first bits into
slices of a bounded size; each slice is one pass over the column of hashes, so neither memory nor
what is sent at once grows with the table, and the share of single records that pass (under 14 in
1000) stays the same. A partition's filters travel as the positions of their bits where these are few.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemma.llm.text_forms import reader_form
from stemma.session import Scratch, fed, written

#: Bits of the largest slice of the filter: 2**30 bits are 128 MiB, the most that is ever sent to an executor.
SLICE_BITS = 1 << 30
BITS_PER_KEY = 16
PROBES = 2
_CHUNK_BITS = 1 << 16  # so that a position in a chunk has 16 bits
_CHUNK = _CHUNK_BITS // 64

_YEAR = r"(?:19|20)\d\d"
_YEAR_FIRST = re.compile(rf"^[\s\W_]*?[\(\[]?({_YEAR})[\)\]]?(?:\s*[-–—.:|/,;_]+|\s)\s*(?=\S)")
_YEAR_LAST = re.compile(rf"(?:[-–—|/,;:\(\[]\s*)({_YEAR})[\)\]]?[\s\W_]*$")


def canonical(title: str | None, year: int | None) -> tuple[str | None, int | None]:
    """Letters and digits of the title, case folded, and the year.

    Without a year of its own, a record takes one that leads or ends the title cell. A title without
    letters and digits (null, blank, only punctuation) has a null key and is nobody's copy.
    """
    if title is None:
        return None, year
    shown = reader_form(title)
    if year is None:
        m = _YEAR_FIRST.search(shown)
        if m:
            shown, year = shown[m.end() :], int(m.group(1))
        elif m := _YEAR_LAST.search(shown):
            shown, year = shown[: m.start()], int(m.group(1))
    key = "".join(c for c in shown.casefold() if c.isalnum())
    return key or None, year


_KEY = T.StructType([T.StructField("text", T.StringType()), T.StructField("year", T.IntegerType())])


@F.pandas_udf(_KEY)
def canonical_key(title: pd.Series, year: pd.Series) -> pd.DataFrame:
    keys = [canonical(t if isinstance(t, str) else None, None if pd.isna(y) else int(y)) for t, y in zip(title, year)]
    return pd.DataFrame({"text": [k for k, _ in keys], "year": pd.array([y for _, y in keys], dtype="Int32")})


def filter_bits(n: int) -> int:
    """Bits of the whole filter: a power of two of at least 16 bits a key."""
    return max(_CHUNK_BITS, 1 << (max(1, n * BITS_PER_KEY) - 1).bit_length())


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions of each hash, one row a probe."""
    h = h.astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([(h + np.uint64(j) * step) & np.uint64(bits - 1) for j in range(PROBES)])


def _have(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    got = (words[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63))) & np.uint64(1)
    return got.all(axis=0)


def _put(words: np.ndarray, places: np.ndarray) -> None:
    p = places.ravel()
    np.bitwise_or.at(words, (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))


def _packed(words: np.ndarray) -> bytes:
    """A chunk as 16-bit positions of its bits, or as it is where that is shorter."""
    at = np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))
    return at.astype(np.uint16).tobytes() if 2 * len(at) < 8 * _CHUNK else words.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    if len(raw) == 8 * _CHUNK:
        return np.frombuffer(raw, np.uint64)
    bits = np.zeros(_CHUNK_BITS, np.uint8)
    bits[np.frombuffer(raw, np.uint16)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _partition_filters(bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = np.zeros(bits // 64, np.uint64)
        again = np.zeros(bits // 64, np.uint64)
        for b in batches:
            h, n = np.unique(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), return_counts=True)
            places = _places(h, bits)
            repeated = (n > 1) | _have(once, places)
            _put(again, places[:, repeated])
            _put(once, places)
        for c in np.flatnonzero(once.reshape(-1, _CHUNK).any(axis=1)).tolist():
            own = slice(c * _CHUNK, (c + 1) * _CHUNK)
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([_packed(once[own])], pa.binary()), pa.array([_packed(again[own])], pa.binary())], ["chunk", "once", "again"])

    return build


def _merge_chunk(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    once = again = None
    for b in rows:
        for x, y in zip(b.column("once"), b.column("again")):
            a, r = _unpacked(x.as_py()), _unpacked(y.as_py())
            if once is None:
                once, again = a.copy(), r.copy()
            else:
                again |= r | (once & a)
                once |= a
    if again is not None and again.any():
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([_packed(again)], pa.binary())], ["chunk", "again"])


def repeat_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """Merged filter, of ``bits`` bits, of the hashes (column 0, bigint) that occur repeatedly.

    Each partition makes one pair where it stands; chunks without any set bit are not sent.
    """
    parts = hashes.mapInArrow(_partition_filters(bits), "chunk int, once binary, again binary")
    merged = parts.groupBy("chunk").applyInArrow(_merge_chunk, "chunk int, again binary")
    words = np.zeros(bits // 64, np.uint64)
    for row in merged.toLocalIterator():
        words[row.chunk * _CHUNK :][:_CHUNK] = _unpacked(bytes(row.again))
    return words


def possible_repeat(words: np.ndarray, spark: SparkSession):
    """Column function: whether the filter has the hash."""
    shared = spark.sparkContext.broadcast(words)  # at most SLICE_BITS

    @F.pandas_udf(T.BooleanType())
    def has(h: pd.Series) -> pd.Series:
        w = shared.value
        return pd.Series(_have(w, _places(h.to_numpy().view(np.uint64), len(w) * 64)))

    return has


def keyed(papers: DataFrame) -> DataFrame:
    """``paper_id, text, year, h``: canonical text and year of each record and their hash.

    ASCII titles of dated records never leave the JVM.
    """
    plain = F.coalesce(F.col("title").rlike(r"^[\x00-\x7f]*$"), F.lit(True)) & (F.col("publication_year").isNotNull() | F.col("title").isNull())
    rows = fed(papers.select("paper_id", "title", "publication_year")).withColumn("plain", plain)
    other = canonical_key(F.when(~F.col("plain"), F.col("title")), F.col("publication_year"))
    own = F.struct(F.nullif(F.lower(F.regexp_replace("title", "[^A-Za-z0-9]", "")), F.lit("")).alias("text"), F.col("publication_year").cast("int").alias("year"))
    rows = rows.select("paper_id", F.when(F.col("plain"), own).otherwise(other).alias("k")).select("paper_id", "k.text", "k.year")
    return rows.withColumn("h", F.xxhash64("text", "year"))


def copy_groups(papers: DataFrame, slice_bits: int = SLICE_BITS) -> DataFrame:
    """``paper_id, group_id, n_copies`` for every record; ``group_id`` is the group's smallest id.

    Records with a null key are groups of one. A row delivered twice with one id counts once.
    A hot group is counted by partial aggregation, never collected into one task.
    """
    spark = papers.sparkSession
    with Scratch(spark) as tables:
        rows = tables.written(keyed(papers), "keyed")
        has_key = rows.where(F.col("text").isNotNull())
        bits = filter_bits(has_key.count())
        slices = max(1, bits // slice_bits)
        first = (slices - 1).bit_length()
        own_slice = F.shiftrightunsigned("h", 64 - first).cast("int") if first else F.lit(0)
        marked = []
        for n in range(slices):
            own = has_key.where(own_slice == n) if first else has_key
            maybe = possible_repeat(repeat_filter(own.select("h"), bits // slices), spark)
            marked.append(tables.written(own.select("paper_id", "text", "year", maybe(F.col("h")).alias("maybe")), "marked"))
        marked = reduce(DataFrame.unionByName, marked)
        suspects = marked.where("maybe").select("paper_id", "text", "year").dropDuplicates(["paper_id"])
        suspects = tables.written(suspects, "suspects")
        groups = suspects.groupBy("text", "year").agg(F.min("paper_id").alias("group_id"), F.count(F.lit(1)).alias("n_copies"))
        # nulls of the year compare as equal
        s, g = suspects.alias("s"), groups.alias("g")
        exact = s.join(g, (F.col("s.text") == F.col("g.text")) & F.col("s.year").eqNullSafe(F.col("g.year"))).select("s.paper_id", "g.group_id", "g.n_copies")
        lone = marked.where("not maybe").select("paper_id").unionByName(rows.where("text is null").select("paper_id").distinct())
        alone = lone.select("paper_id", F.col("paper_id").alias("group_id"), F.lit(1).cast("bigint").alias("n_copies"))
        return written(exact.unionByName(alone), "groups")


def copy_pairs(groups: DataFrame) -> DataFrame:
    """All pairs of each group, smaller id first, as the result's definition asks for."""
    many = groups.where("n_copies > 1").select("group_id", "paper_id")
    a, b = many.alias("a"), many.alias("b")
    on = (F.col("a.group_id") == F.col("b.group_id")) & (F.col("a.paper_id") < F.col("b.paper_id"))
    return a.join(b, on).select(F.col("a.paper_id").alias("paper_id_a"), F.col("b.paper_id").alias("paper_id_b"))


def one_record_each(groups: DataFrame) -> DataFrame:
    """One row a paper: ``paper_id`` (the smallest of its copies) and ``n_copies``."""
    return groups.where("paper_id = group_id").select("paper_id", "n_copies")


# ---- survivorship -------------------------------------------------------------------------------

# The order of the states of a record.
STATUSES = ("DISCOVERED", "METADATA_FOUND", "ABSTRACT_FOUND", "FULL_TEXT_FOUND", "DOWNLOADED", "INGESTING", "PROCESSED", "VERIFIED")

_PLACEHOLDER = r"(?i)^[\s\W_]*(n/?a|nan|none|null|nil|tb[ad]|pending|unknown|missing|-+|\.+|see (the )?(pdf|publisher|full text|paper|article)|(no )?(abstract|summary)( (text|is|was))?( (not|no longer|un))?[ -]?(available|missing|provided|found|present)?( (by|from|at|in) [\w ]+)?|(abstract|summary) (forthcoming|pending|to follow)|no (abstract|summary).{0,40})[\s\W_]*$"
# What pages say instead of an abstract. Whatever else they say is known by being said of many records.
_NOTICE = r"(?i)(subscri(be|ption)|sign in|log ?in|register to|cookies?|request access|through your library|enable javascript|purchase (access|this)|all rights reserved|access (denied|options)|terms of use|privacy policy)"
#: Records whose abstracts hold the same sentence (of three words or more, without digits) from which it is a notice.
BOILERPLATE = 5
_CUT = r"(?i)(…|\.\.+|\[\s*(…|\.\.\.|truncated|cut|more|continued)\s*\]?|[\(\[<]\s*(read |show |see )?(more|truncated|continued?|cont\.?d?)\s*[\)\]>]|(read|show|see) more)\s*$"


def whole_doi(doi: Column) -> Column:
    """Whether the cell holds a complete DOI: prefix ``10.`` with digits, a slash and a suffix."""
    return F.coalesce(doi.rlike(r"(?i)(?:^|[\s:/])10\.\d{4,9}/[^\s/;,.][^\s]*"), F.lit(False))


def _sentences(abstract: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(abstract, r"(?U)^\s+|\s+$", ""), r"(?<=[.!?。！？])\s*"), lambda x: F.length(F.trim(x)) > 0)


def whole_abstract(abstract: Column, notices: Column) -> Column:
    """Whether the cell holds a whole abstract: not blank, cut, a placeholder, or for the half of its sentences notices (``notices`` is their number)."""
    t = F.regexp_replace(abstract, r"(?U)^\s+|\s+$", "")
    good = (F.length(t) > 0) & ~t.rlike(_PLACEHOLDER) & ~t.rlike(_CUT) & t.rlike(r"""[.!?。！？]["'”’»)\]]*$""") & (notices * 2 < F.size(_sentences(abstract)))
    return F.coalesce(good, F.lit(False))


def notice_counts(papers: DataFrame, groups: DataFrame, boilerplate: int = BOILERPLATE) -> DataFrame:
    """``paper_id, abstract, notices`` of the members of groups: how many sentences of the abstract are notices.

    A sentence is one if it speaks of access, or if ``boilerplate`` records of different groups have it.
    Sentences are counted over all records, by their hashes.
    """
    own = papers.where("abstract is not null").select("paper_id", "abstract").join(groups, "paper_id")
    said = own.select("paper_id", "group_id", "n_copies", F.col("abstract"), F.explode(_sentences(F.col("abstract"))).alias("x"))
    bare = F.lower(F.trim(F.regexp_replace("x", r"(?U)\W+", " ")))
    countable = ~bare.rlike(r"\d") & (F.size(F.split(bare, " ")) >= 3)
    said = said.select("paper_id", "group_id", "n_copies", F.xxhash64("abstract").alias("a"), F.when(countable, F.xxhash64(bare)).alias("s"), F.col("x").rlike(_NOTICE).alias("access"))
    many = said.where("s is not null").select("s", "group_id").distinct().groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= boilerplate).select("s", F.lit(True).alias("many"))
    judged = said.where("n_copies > 1").join(many, "s", "left")
    return judged.groupBy("paper_id", "a").agg(F.sum((F.col("access") | F.coalesce("many", F.lit(False))).cast("int")).alias("notices"))


def status_rank(status: Column) -> Column:
    """1 for the first state to 8 for the furthest; null for what is no state. Spelling is free."""
    folded = F.upper(F.regexp_replace(F.regexp_replace(status, r"(?U)^\W+|\W+$", ""), r"(?U)[\W_]+", "_"))
    rank = F.lit(None).cast("int")
    for i, name in enumerate(STATUSES):
        rank = F.when(folded == name, F.lit(i + 1)).otherwise(rank)
    return rank


def source_key(name: Column) -> Column:
    """Letters and digits of a source's name in lower case; null if there are none."""
    return F.nullif(F.lower(F.regexp_replace(name, r"(?U)[\W_]+", "")), F.lit(""))


def survivors(papers: DataFrame, sources: DataFrame, groups: DataFrame) -> DataFrame:
    """``group_id, field_name, paper_id``: the row whose value survives, field by field.

    One aggregation takes for each attribute the maximum of a struct (valid value, its priority,
    ``updated_at``, smaller id last) by group. A group of one, and a field without a valid value in
    its group, have no row. A paper delivered twice with one id is judged by its latest row; a
    source name that occurs twice in ``sources`` counts by its lowest rank.
    """
    members = groups.where("n_copies > 1").select(F.col("paper_id").alias("member_id"), "group_id")
    ranks = sources.select(source_key(F.col("source_name")).alias("source_key"), "trust_rank").where("source_key is not null").groupBy("source_key").agg(F.min("trust_rank").alias("rank"))
    notices = notice_counts(papers, groups).select(F.col("paper_id").alias("noticed"), "a", "notices")
    own = papers.select("paper_id", "updated_at", "doi", "abstract", "metadata_status", "source_name")
    own = own.join(members, own.paper_id == members.member_id)
    own = own.join(notices, (F.col("paper_id") == F.col("noticed")) & (F.xxhash64("abstract") == F.col("a")), "left")
    judged = own.select(
        "paper_id",
        "group_id",
        "updated_at",
        whole_doi(F.col("doi")).alias("doi_ok"),
        whole_abstract(F.col("abstract"), F.coalesce("notices", F.lit(0))).alias("abstract_ok"),
        status_rank(F.col("metadata_status")).alias("status"),
        source_key(F.col("source_name")).alias("source_key"),
    )
    rows = judged.join(ranks, "source_key", "left")

    def best(valid: Column, priority: Column) -> Column:
        return F.max(F.when(valid, F.struct(priority.cast("bigint").alias("p"), F.col("updated_at").alias("u"), (-F.col("paper_id")).alias("i"))))

    one = rows.groupBy("group_id").agg(
        best(F.col("doi_ok"), F.lit(0)).alias("doi"),
        best(F.col("abstract_ok"), F.lit(0)).alias("abstract"),
        best(F.col("status").isNotNull(), F.col("status")).alias("metadata_status"),
        best(F.col("rank").isNotNull(), -F.col("rank")).alias("source_name"),
    )
    names = ("doi", "abstract", "metadata_status", "source_name")
    long = one.select("group_id", F.explode(F.array(*(F.struct(F.lit(x).alias("field_name"), (-F.col(f"{x}.i")).alias("paper_id")) for x in names))).alias("v"))
    return long.select("group_id", "v.field_name", "v.paper_id").where("paper_id is not null")
