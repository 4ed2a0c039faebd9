"""Matching people of two sources that share no key, by loopy belief propagation.

Candidate pairs meet by an identifier, by a family name (through the trie join), or by their given
names at one institution. Each pair gets log odds from its noisy attributes. Every record of either
side is a factor that speaks against its having more than one partner (a partner beyond the first
costs ``RHO``; a record may be in a source twice, so it is no ban). Messages between pairs and
factors are exchanged by aggregations and joins until they settle; the pair's marginal is its
confidence.

For a factor with partners of odds ``o_1 .. o_k`` that weighs a choice of ``m`` partners by
``RHO ** max(0, m - 1)``, the message to a pair has a closed form in the product of
``1 + RHO * o_j`` over the others, so one sum a record is all that is ever gathered.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stemma.llm.names import edits, given_match, institution, institution_match, name_score, readings
from stemma.llm.people import Meeting, digits, given_words, name_id, names_of, roster, spelled, with_place
from stemma.session import Scratch, spread, written

#: Factor by which each partner beyond a record's first is less likely.
RHO = 0.1
#: Log odds: of any candidate; of the name score from a bound on; of the institution; of identifiers.
BASE = -2.0
NAME = ((0.95, 3.0), (0.8, 2.5), (0.69, 2.2), (0.5, 0.0), (0.0, -5.0))
SAME_GIVEN, SAME_GIVENS = -2.0, -1.3  # the family name differs, one or more given names are equal
PLACE = {"same": 4.0, "unknown": 0.0, "other": -5.0}
ORCID = {"same": 7.0, "near": 2.0, "other": -5.0}
SCHOLAR = {"same": 7.0, "near": 1.0, "other": -4.0}
#: Pairs below these log odds are contradicted; they bear on no other pair.
FLOOR = -3.9
MATCH = 0.5


def log_odds(name_a, other_a, place_a, orcid_a, scholar_a, name_b, place_b, orcid_b, scholar_b) -> float:
    """Evidence for a pair; an absent attribute says nothing."""
    score = max(name_score(name_a, name_b), name_score(other_a, name_b) if other_a else 0.0)
    total = BASE
    if score < 0.5:
        total += _given_evidence(name_a, name_b)
    else:
        total += next(v for bound, v in NAME if score >= bound)
    place = institution_match(place_a, place_b)
    total += PLACE["same" if place > 0.5 else "unknown" if place == 0.5 else "other"]
    for x, y, weights in ((orcid_a, orcid_b, ORCID), (scholar_a, scholar_b, SCHOLAR)):
        if x and y:
            total += weights["same" if x == y else "near" if edits(x, y, 1) == 1 else "other"]
    return total


def _given_evidence(a: str | None, b: str | None) -> float:
    best = NAME[-1][1]
    for _, ga in readings(a)[0][:1]:
        for _, gb in readings(b)[0][:1]:
            if ga and gb and len(ga[0]) > 1 and given_match(ga[0], gb[0]) >= 0.8:
                best = max(best, SAME_GIVENS if len(ga) > 1 and len(gb) > 1 and len(ga[1]) > 1 and ga[1] == gb[1] else SAME_GIVEN)
    return best


@F.pandas_udf(T.DoubleType())
def _log_odds(na: pd.Series, oa: pd.Series, pa: pd.Series, ia: pd.Series, sa: pd.Series, nb: pd.Series, pb: pd.Series, ib: pd.Series, sb: pd.Series) -> pd.Series:
    text = lambda x: x if isinstance(x, str) else None
    return pd.Series([log_odds(*map(text, row)) for row in zip(na, oa, pa, ia, sa, nb, pb, ib, sb)], dtype=float)


@F.pandas_udf(T.StringType())
def _givens_at(names: pd.Series, places: pd.Series) -> pd.Series:
    """Two full given names and the institution as one key; null without either."""

    def key(n, p) -> str | None:
        at = institution(p if isinstance(p, str) else None)
        found = readings(n if isinstance(n, str) else None)[0]
        if not at or not at[0] or not found or len(found[0][1]) < 2:
            return None
        g = found[0][1]
        return f"{g[0]} {g[1]} @ {at[0]}" if len(g[0]) > 2 and len(g[1]) > 2 else None

    return pd.Series([key(n, p) for n, p in zip(names, places)])


def candidate_pairs(tables: Scratch, people: DataFrame, profiles: DataFrame, givens: DataFrame) -> DataFrame:
    """``professor_id, profile_id`` that meet by an identifier, by name and institution, or by the whole name where one has no institution."""
    parts = ["name_id", "name", "other"]
    names = tables.written(names_of(people.select(parts).unionByName(profiles.select(parts))), "names")
    a = profiles.select(F.col("profile_id").alias("id"), "name_id", "at")
    b = people.select(F.col("professor_id").alias("id"), "name_id", "at")
    met = Meeting(tables, a, b, tables.written(spelled(names, givens), "keys"))
    ways = [met.at_place().select(F.col("id_b").alias("professor_id"), F.col("id_a").alias("profile_id"))]
    x = a.select(F.col("id").alias("profile_id"), F.col("name_id").alias("name_a"), F.col("at.place").isNull().alias("lost_a"))
    y = b.select(F.col("id").alias("professor_id"), F.col("name_id").alias("name_b"), F.col("at.place").isNull().alias("lost_b"))
    anywhere = tables.written(met.anywhere(), "anywhere")
    ways.append(anywhere.join(x, "name_a").join(y, "name_b").where("lost_a or lost_b").select("professor_id", "profile_id"))
    for c in ("orcid", "scholar"):
        ways.append(people.select("professor_id", F.col(c).alias("k")).where("k is not null").join(profiles.select("profile_id", F.col(c).alias("k")).where("k is not null"), "k").select("professor_id", "profile_id"))
    p = people.select("professor_id", _givens_at("name", "place").alias("k")).where("k is not null")
    q = profiles.select("profile_id", _givens_at("name", "place").alias("k")).where("k is not null")
    ways.append(p.join(q, "k").select("professor_id", "profile_id"))
    return reduce(DataFrame.unionByName, ways).distinct()


def _answer(total: Column, own: Column, rho: float) -> Column:
    """Log message of a factor to a pair, from the sum of ``log(1 + rho * odds)`` with and without it."""
    x = F.greatest(total - own, F.lit(0.0))
    small = F.least(x, F.lit(30.0))
    return F.when(x > 30.0, F.log(F.lit(rho))).otherwise(small - F.log(1 + (F.exp(small) - 1) / rho))


def _softplus(q: Column, rho: float) -> Column:
    """``log(1 + rho * exp(q))`` without overflow."""
    z = q + F.log(F.lit(rho))
    return F.when(z > 30.0, z).otherwise(F.log1p(F.exp(F.least(z, F.lit(30.0)))))


def _round(state: DataFrame, rho: float, damping: float) -> DataFrame:
    """One exchange of messages, first with the factors of side a, then of side b."""
    for side, own, other in (("a", "from_a", "from_b"), ("b", "from_b", "from_a")):
        said = state.withColumn("say", _softplus(F.col("prior") + F.col(other), rho))
        total = said.groupBy(F.col(side).alias("node")).agg(F.sum("say").alias("total"))
        heard = said.join(total, F.col(side) == F.col("node"))
        new = _answer(F.col("total"), F.col("say"), rho)
        state = heard.withColumn("new", damping * F.col(own) + (1 - damping) * new)
        state = state.withColumn("moved", F.greatest("moved", F.abs(F.col("new") - F.col(own)))).withColumn(own, F.col("new")).select("a", "b", "prior", "from_a", "from_b", "moved")
    return state


class Unsettled(RuntimeError):
    """Messages still move after the last round allowed."""


def marginals(pairs: DataFrame, rho: float = RHO, rounds: int = 400, tolerance: float = 0.01, damping: float = 0.2, tables: Scratch | None = None) -> DataFrame:
    """``a, b, confidence`` from ``a, b, prior`` (log odds), one row a pair.

    Pairs whose records have no other pair need no messages. The others exchange messages, two
    rounds between two tables in the shared folder, until none moves by ``tolerance``. Every 32 rounds
    the damping grows by half of what is left to 1, which ends swings. ``Unsettled`` is raised, with
    the greatest change left, if ``rounds`` are not enough; no unsettled confidence is ever returned.
    """
    write = tables.written if tables else written
    na = pairs.groupBy(F.col("a").alias("na")).agg(F.count(F.lit(1)).alias("da"))
    nb = pairs.groupBy(F.col("b").alias("nb")).agg(F.count(F.lit(1)).alias("db"))
    seen = write(pairs.join(na, F.col("a") == F.col("na")).join(nb, F.col("b") == F.col("nb")).select("a", "b", "prior", (F.greatest("da", "db") > 1).alias("open")), "pairs")
    sigmoid = lambda c: 1 / (1 + F.exp(-c))
    settled = seen.where("not open").select("a", "b", sigmoid(F.col("prior")).alias("confidence"))
    zero = F.lit(0.0)
    state = seen.where("open").select("a", "b", "prior", zero.alias("from_a"), zero.alias("from_b"), zero.alias("moved"))
    top, done = None, 0
    while True:
        state = _round(state, rho, damping)
        state = write(_round(state.withColumn("moved", zero), rho, damping), "messages")
        done += 2
        top = state.agg(F.max("moved")).first()[0]
        # a damped message moves by less than what it is off
        if top is None or top < tolerance * (1 - damping):
            break
        if done >= rounds:
            raise Unsettled(f"after {done} rounds a message still moves by {top:.3g}")
        if done % 32 == 0:
            damping += (1 - damping) / 2
        state = state.withColumn("moved", zero)
    return settled.unionByName(state.select("a", "b", sigmoid(F.col("prior") + F.col("from_a") + F.col("from_b")).alias("confidence")))


def matches(professors: DataFrame, departments: DataFrame | None, profiles: DataFrame) -> DataFrame:
    """``professor_id, profile_id, confidence`` of every candidate pair that is not contradicted.

    Rows without any attribute are in no pair. Identifiers are compared in one notation, and
    placeholders are none. A row delivered twice under one id counts once.
    """
    with Scratch(professors.sparkSession) as tables:
        people = tables.written(roster(professors, departments).withColumn("name_id", name_id(F.col("name"), F.col("other"))), "roster")
        givens = given_words(professors)
        place = F.when(F.trim("affiliation") != "", F.col("affiliation"))
        own = with_place(profiles.select("profile_id", "display_name", "orcid", "scholar_ref", "affiliation").dropDuplicates(["profile_id"]).withColumn("place", place))
        own = own.select("profile_id", "at", F.col("display_name").alias("name"), F.lit(None).cast("string").alias("other"), "place", digits(F.col("orcid"), 16).alias("orcid"), digits(F.col("scholar_ref"), 11).alias("scholar"))
        own = tables.written(own.withColumn("name_id", name_id(F.col("name"), F.col("other"))), "profiles")
        pairs = candidate_pairs(tables, people, own, givens)
        a = people.select("professor_id", *(F.col(c).alias(f"{c}_a") for c in ("name", "other", "place", "orcid", "scholar")))
        b = own.select("profile_id", *(F.col(c).alias(f"{c}_b") for c in ("name", "place", "orcid", "scholar")))
        rated = spread(pairs.join(a, "professor_id").join(b, "profile_id")).select(
            F.col("professor_id").alias("a"),
            F.col("profile_id").alias("b"),
            _log_odds("name_a", "other_a", "place_a", "orcid_a", "scholar_a", "name_b", "place_b", "orcid_b", "scholar_b").alias("prior"),
        )
        open_ = tables.written(rated.where(F.col("prior") >= FLOOR), "rated")
        found = marginals(open_, tables=tables).select(F.col("a").alias("professor_id"), F.col("b").alias("profile_id"), "confidence")
        return written(found, "matches")
