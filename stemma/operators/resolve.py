"""Resolving author occurrences to people of a roster: a ladder of name agreement and a decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stemma.functions import text as X
from stemma.functions.unicode import ratio
from stemma.operators.joins import other_in_group, unique_candidate
from stemma.operators.quality import first_reason

#: Confidence of each rung that needs no similarity.
RUNGS = {"EXACT": 1.0, "FIRST_LAST": 0.95, "FIRST_INITIAL": 0.9, "INITIALS": 0.9}
HIGH, MEDIUM = 0.85, 0.65


def exact_rungs(author: Column, person: Column) -> Column:
    """Name of the first rung that holds between two normalised names, null for none."""
    a, p = X.name_parts(author), X.name_parts(person)
    last = a["last"] == p["last"]
    initial = lambda x: F.substring(x["first"], 1, 1)
    return first_reason(
        [
            ("EXACT", author == person),
            ("FIRST_LAST", last & (a["first"] == p["first"])),
            ("FIRST_INITIAL", last & (F.length(a["first"]) == 1) & (initial(a) == initial(p))),
            ("INITIALS", last & (a["initials"] == p["initials"])),
        ]
    )


def name_ladder(pairs: DataFrame, author: str, person: str) -> DataFrame:
    """``pairs`` with ``rung`` and ``confidence``.

    Only pairs that no exact rung takes reach Python for their similarity (author first: it is not
    symmetric). A null or blank name agrees with nothing.
    """
    rung = exact_rungs(F.col(author), F.col(person))
    rated = pairs.withColumn("_e", rung).withColumn("_s", ratio(F.when(F.col("_e").isNull(), F.col(author)), F.when(F.col("_e").isNull(), F.col(person))))
    by_ratio = F.when(F.col("_s") >= HIGH, "HIGH_SIMILARITY").when(F.col("_s") >= MEDIUM, "MEDIUM_SIMILARITY").otherwise("MISMATCH")
    confidence = F.lit(None).cast("double")
    for name, c in RUNGS.items():
        confidence = F.when(F.col("_e") == name, F.lit(c)).otherwise(confidence)
    return pairs_out(rated, by_ratio, confidence)


def pairs_out(rated: DataFrame, by_ratio: Column, confidence: Column) -> DataFrame:
    return rated.withColumn("rung", F.coalesce("_e", by_ratio)).withColumn("confidence", F.coalesce(confidence, F.round("_s", 4), F.lit(0.0))).drop("_e", "_s")


def resolved(occurrences: DataFrame, roster: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """One decision for each occurrence: ``occurrence_id, person_id, classification, confidence``.

    ``occurrences``: ``occurrence_id, publication_id, person_ref, name`` (normalised); ``roster``:
    ``person_id, name``; ``overrides``: ``name, person_id`` (none by default). In this order:

    * a reference to a person of the roster: by the ladder; if the name contradicts it while another
      occurrence of the publication has the person's name, the references were swapped;
    * a curated override; then the only person with the same first and last name;
    * else ``UNKNOWN_REFERENCE`` or ``UNRESOLVED``.
    """
    p = roster.select(F.col("person_id").alias("p_id"), F.col("name").alias("p_name"))
    with_ref = occurrences.join(p, F.col("person_ref") == F.col("p_id"), "left")
    known = name_ladder(with_ref.where("p_id is not null"), "name", "p_name")
    # another occurrence of the publication that has the name of the referred person
    names = occurrences.select("publication_id", F.col("name").alias("p_name"), F.col("occurrence_id").alias("_other")).distinct()
    swapped = known.where("rung = 'MISMATCH'").join(names, ["publication_id", "p_name"]).where("_other <> occurrence_id").select("occurrence_id").distinct().withColumn("_swap", F.lit(True))
    known = known.join(swapped, "occurrence_id", "left")
    kind = F.when(F.col("_swap"), "ID_SWAP").otherwise(F.col("rung"))
    kept = ~kind.isin("ID_SWAP", "MISMATCH")
    decided = known.select("occurrence_id", F.when(kept, F.col("p_id")).alias("person_id"), kind.alias("classification"), F.when(kept, F.col("confidence")).otherwise(F.lit(0.0)).alias("confidence"))

    rest = with_ref.where("p_id is null").select("occurrence_id", "person_ref", "name")
    if overrides is not None:
        o = overrides.select(F.col("name").alias("o_name"), F.col("person_id").alias("o_id"))
        rest = rest.join(o, F.col("name") == F.col("o_name"), "left").drop("o_name")
    else:
        rest = rest.withColumn("o_id", F.lit(None).cast(dict(roster.dtypes)["person_id"]))
    key = lambda c: F.when(F.size(F.split(c, " ")) > 1, F.concat(X.name_parts(c)["first"], F.lit(" "), X.name_parts(c)["last"]))
    only = unique_candidate(rest.select("occurrence_id", key(F.col("name")).alias("k")), "occurrence_id", roster.select("person_id", key(F.col("name")).alias("k")), ["k"], "person_id")
    rest = rest.join(only, "occurrence_id", "left")
    other = rest.select(
        "occurrence_id",
        F.coalesce("o_id", "person_id").alias("person_id"),
        F.when(F.col("o_id").isNotNull(), "OVERRIDE").when(F.col("person_id").isNotNull(), "UNIQUE_NAME").when(F.col("person_ref").isNotNull(), "UNKNOWN_REFERENCE").otherwise("UNRESOLVED").alias("classification"),
        F.when(F.col("o_id").isNotNull(), 1.0).when(F.col("person_id").isNotNull(), 0.95).otherwise(0.0).alias("confidence"),
    )
    return decided.unionByName(other)


#: Classes of the decision: the first four are accepted by themselves.
CLASSES = ("EXACT", "NAME_VARIANT", "INITIAL_VARIANT", "HIGH_SIMILARITY", "MODERATE_REVIEW", "ID_MISMATCH", "UNKNOWN", "ID_SWAP_RECOVERED", "NAME_WITHOUT_ID", "NAME_VARIANT_WITHOUT_ID", "EXTERNAL")


def name_class(author: Column, person: Column) -> Column:
    """Class of two normalised names where no similarity is needed, null otherwise."""
    a, p = X.name_parts(author), X.name_parts(person)
    last = a["last"] == p["last"]
    return first_reason(
        [
            ("UNKNOWN", author.isNull() | person.isNull() | (author == "") | (person == "")),
            ("EXACT", author == person),
            ("NAME_VARIANT", last & (a["first"] == p["first"])),
            ("INITIAL_VARIANT", last & ((F.substring(a["first"], 1, 1) == F.substring(p["first"], 1, 1)) | (a["initials"] == p["initials"]))),
        ]
    )


def decisions(occurrences: DataFrame, roster: DataFrame, curated: DataFrame | None = None) -> DataFrame:
    """One decision for each occurrence: ``occurrence_id, person_id, person_name, classification, confidence, evidence``.

    ``occurrences``: ``occurrence_id, publication_id, person_ref, name`` (normalised); ``roster``:
    ``person_id, name``; ``curated``: ``person_id, name, evidence``. In this order:

    * with a reference to a person of the roster: by the names. If they contradict each other, and another
      occurrence of the publication has the person's name, the references were swapped and nothing is
      mapped; else a curated variant counts; else the class itself, for review or of low confidence;
    * with a reference to nobody of the roster: ``EXTERNAL``;
    * without a reference: the person of this very name (the last one, of several); else the only person
      with first and last name alike whom another occurrence of the publication refers to, for review;
      else ``EXTERNAL``.

    ``evidence`` is a struct of what was seen. An occurrence or person that comes twice counts once.
    """
    occ = occurrences.select("occurrence_id", "publication_id", "person_ref", F.nullif("name", F.lit("")).alias("name")).dropDuplicates(["occurrence_id"])
    people = roster.groupBy(F.col("person_id").alias("p_id")).agg(F.min("name").alias("p_name"))
    referred = occ.join(people, F.col("person_ref") == F.col("p_id"), "left")

    known = referred.where("p_id is not null").withColumn("_e", name_class(F.col("name"), F.col("p_name")))
    open_ = F.col("_e").isNull()
    known = known.withColumn("_s", ratio(F.when(open_, F.col("name")), F.when(open_, F.col("p_name"))))
    known = known.withColumn("_c", F.coalesce("_e", F.when(F.col("_s") >= HIGH, "HIGH_SIMILARITY").when(F.col("_s") >= MEDIUM, "MODERATE_REVIEW").otherwise("ID_MISMATCH")))
    good = F.col("_c").isin("EXACT", "NAME_VARIANT", "INITIAL_VARIANT", "HIGH_SIMILARITY")
    names = occ.where("name is not null").select("publication_id", F.col("name").alias("p_name"), F.col("occurrence_id").alias("_other"))
    swapped = known.where(~good).join(names, ["publication_id", "p_name"]).where("_other <> occurrence_id").select("occurrence_id").distinct().withColumn("_swap", F.lit(True))
    known = known.join(swapped, "occurrence_id", "left")
    if curated is not None:
        c = curated.groupBy(F.col("person_id").alias("c_id"), F.col("name").alias("c_name")).agg(F.min("evidence").alias("_why"))
        known = known.join(c, (F.col("p_id") == F.col("c_id")) & (F.col("name") == F.col("c_name")), "left")
    else:
        known = known.withColumn("_why", F.lit(None).cast("string"))
    kind = F.when(good, F.col("_c")).when(F.col("_swap"), "ID_SWAP_RECOVERED").when(F.col("_why").isNotNull(), "NAME_VARIANT").otherwise(F.col("_c"))
    sure = F.when(kind == "HIGH_SIMILARITY", "MEDIUM").when(kind == "MODERATE_REVIEW", "REVIEW").when(kind.isin("ID_MISMATCH", "UNKNOWN"), "LOW").otherwise("HIGH")
    mapped = kind.isin("EXACT", "NAME_VARIANT", "INITIAL_VARIANT", "HIGH_SIMILARITY")
    evidence = lambda **x: F.struct(*(x.get(k, F.lit(None)).cast(t).alias(k) for k, t in (("reference", "string"), ("similarity", "double"), ("candidates", "bigint"), ("supported", "bigint"), ("curated", "string"))))
    a = known.select(
        "occurrence_id", F.when(mapped, F.col("p_id")).alias("person_id"), F.when(mapped, F.col("p_name")).alias("person_name"), kind.alias("classification"), sure.alias("confidence"),
        evidence(reference=F.lit("on the roster"), similarity=F.round("_s", 4), curated=F.when(kind == "NAME_VARIANT", F.col("_why"))).alias("evidence"),
    )
    none = F.lit(None)
    key = dict(roster.dtypes)["person_id"]
    b = referred.where("p_id is null and person_ref is not null").select("occurrence_id", none.cast(key).alias("person_id"), none.cast("string").alias("person_name"), F.lit("EXTERNAL").alias("classification"), F.lit("NONE").alias("confidence"), evidence(reference=F.lit("not on the roster")).alias("evidence"))

    rest = referred.where("person_ref is null").select("occurrence_id", "publication_id", "name")
    named = people.where("p_name <> ''").groupBy(F.col("p_name").alias("name")).agg(F.max("p_id").alias("same_id"))
    ends = lambda c: F.when(c != "", F.concat(X.name_parts(c)["first"], F.lit(" "), X.name_parts(c)["last"]))
    there = occ.where("person_ref is not null").select("publication_id", F.col("person_ref").alias("p_id")).distinct().withColumn("_there", F.lit(True))
    alike = rest.withColumn("_k", ends(F.col("name"))).join(people.withColumn("_k", ends(F.col("p_name"))), "_k").join(there, ["publication_id", "p_id"], "left")
    alike = alike.groupBy("occurrence_id").agg(F.count(F.lit(1)).alias("candidates"), F.count("_there").alias("supported"), F.max(F.when(F.col("_there"), F.struct("p_id", "p_name"))).alias("_best"))
    rest = rest.join(named, "name", "left").join(alike, "occurrence_id", "left")
    direct, one = F.col("same_id").isNotNull(), F.coalesce(F.col("supported") == 1, F.lit(False))
    c = rest.select(
        "occurrence_id",
        F.when(direct, F.col("same_id")).when(one, F.col("_best.p_id")).alias("person_id"),
        F.when(direct, F.col("name")).when(one, F.col("_best.p_name")).alias("person_name"),
        F.when(direct, "NAME_WITHOUT_ID").when(one, "NAME_VARIANT_WITHOUT_ID").otherwise("EXTERNAL").alias("classification"),
        F.when(direct, "HIGH").when(one, "REVIEW").otherwise("NONE").alias("confidence"),
        evidence(reference=F.lit("none"), candidates=F.coalesce("candidates", F.lit(0)), supported=F.coalesce("supported", F.lit(0))).alias("evidence"),
    )
    return a.unionByName(b).unionByName(c)


def graph_ladder(people: DataFrame, nodes: DataFrame, key: Column) -> DataFrame:
    """``name, action`` for each person: ``exists`` (a node of this very name), ``review`` (only a variant by ``key``), ``create``."""
    n = nodes.select("name").distinct()
    exact = people.select("name").distinct().join(n.select(F.col("name").alias("e")), F.col("name") == F.col("e"), "left")
    variants = n.select(key.alias("v")).distinct()
    out = exact.withColumn("_k", key).join(variants, F.col("_k") == F.col("v"), "left")
    return out.select("name", F.when(F.col("e").isNotNull(), "exists").when(F.col("v").isNotNull(), "review").otherwise("create").alias("action"))


__all__ = ["decisions", "exact_rungs", "graph_ladder", "name_ladder", "other_in_group", "resolved"]
