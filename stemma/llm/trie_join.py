"""Trie join: all pairs of words of two columns within a bounded edit distance.

Words of one column (the dictionary) are sharded into tries by their length and a part of the word
that the edits leave as it is. For one edit these are the first half and, reversed, the last half,
two letters in the middle left out: one edit, a swap of neighbours included, leaves at least one of
them. For two edits these are three pieces with one letter left out between two of them, so that no
swap reaches into two pieces and two edits leave at least one. A word of the other column goes to the
shards of its own parts for every length within reach (the middle piece also one letter to the left
and right, since the edit before it may move it), and walks through the trie with a Levenshtein
automaton (a swap counts as one edit) that leaves a branch as soon as nothing in it can be near. So
all pairs within the edits allowed for the word are found: two from seven letters, one from three.
Words of one or two letters match only themselves, since one edit makes any of them any other.

Where both columns come with a group in which alone they may meet (``by``, such as an institution),
a group is one shard, for a group's dictionary is short.

Where one edit is allowed and there are no groups, words meet by what is left of them without one
letter, or without none, and no trie is built: the places and letters left out tell one edit from two.
Only words of very many letters go through tries.

Shards are cut to a bounded number of words on both sides, whatever the letters' frequencies and the
sizes of the groups, and several small ones go to one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORTEST = 3
#: Letters from which a word may be two edits from another.
TWO_EDITS = 7
SHARD_WORDS = 20_000
#: Letters from which words that are one edit apart are found by tries too, since each letter left out is a row.
LONG_WORD = 64


class Automaton:
    """Levenshtein automata of one distance, with transitions worked out once for all words.

    A state is a set of ``(offset, errors, swap)``; the next state depends only on where the letter
    stands among the next few letters of the word, so states and steps are shared by all words.
    """

    def __init__(self, most: int):
        self.most = most
        self.width = 2 * most + 2
        self.mask = (1 << self.width) - 1
        self.states: list[tuple[tuple[int, int, int], ...]] = []
        self.number: dict[tuple[tuple[int, int, int], ...], int] = {}
        self.steps: dict[tuple[int, int], tuple[int, int]] = {}
        self.start, _ = self._state({(0, 0, 0)})

    def _state(self, positions: set[tuple[int, int, int]]) -> tuple[int, int]:
        base = min(i for i, _, _ in positions)
        kept = tuple(
            sorted(
                (i - base, e, t)
                for i, e, t in positions
                if not any((j, f) != (i, e) and not u and not t and f < e and abs(j - i) <= e - f for j, f, u in positions)
            )
        )
        if kept not in self.number:
            self.number[kept] = len(self.states)
            self.states.append(kept)
        return self.number[kept], base

    def step(self, state: int, vector: int) -> tuple[int, int]:
        """Next state and how far its base moves; state -1 is dead. Bit k of the vector: the letter stands k places after the base."""
        known = self.steps.get((state, vector))
        if known is None:
            new: set[tuple[int, int, int]] = set()
            for i, e, t in self.states[state]:
                here = vector >> i
                if t:
                    if here & 1:
                        new.add((i + 2, e, 0))
                    continue
                if here & 1:
                    new.add((i + 1, e, 0))
                left = self.most - e
                if left > 0:
                    new.add((i, e + 1, 0))
                    new.add((i + 1, e + 1, 0))
                    if here & 2:
                        new.add((i, e + 1, 1))
                    for k in range(1, left + 1):
                        if here >> k & 1:
                            new.add((i + k + 1, e + k, 0))
            known = self._state(new) if new else (-1, 0)
            self.steps[state, vector] = known
        return known

    def distance(self, state: int, rest: int) -> int:
        """Edits if the text ends in this state and the word has ``rest`` letters after the base."""
        return min((e + rest - i for i, e, t in self.states[state] if not t and i <= rest), default=self.most + 1)


_AUTOMATA: dict[int, Automaton] = {}


def trie(words: list[str]) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = w
    return root


def near(word: str, root: dict, most: int) -> Iterator[tuple[str, int]]:
    """Words of the trie within ``most`` edits of the word, with their distance."""
    if most not in _AUTOMATA:
        _AUTOMATA[most] = Automaton(most)
    a = _AUTOMATA[most]
    bits: dict[str, int] = {}
    for i, c in enumerate(word):
        bits[c] = bits.get(c, 0) | 1 << i
    n = len(word)
    stack = [(root, a.start, 0)]
    while stack:
        node, state, base = stack.pop()
        for c, child in node.items():
            if c == "":
                d = a.distance(state, n - base)
                if d <= most:
                    yield child, d
                continue
            after, shift = a.step(state, (bits.get(c, 0) >> base) & a.mask)
            if after >= 0:
                stack.append((child, after, base + shift))


def allowed(word: str, most: int = 2) -> int:
    """Edits allowed for a word: none below three letters, one below seven, then ``most``."""
    return 0 if len(word) < SHORTEST else min(most, 1) if len(word) < TWO_EDITS else most


def _front(n: Column) -> Column:
    return F.greatest(F.floor(n / 2) - 1, F.lit(1)).cast("int")


def _back(n: Column) -> Column:
    return F.greatest(n - F.floor(n / 2) - 1, F.lit(1)).cast("int")


def _outer(n: Column) -> Column:
    """Letters of the first and of the last of three pieces; the middle one has the rest but two."""
    return F.floor((n - 1) / 3).cast("int")


def _key(side: str, size: Column, part: Column) -> Column:
    return F.concat(F.lit(side), size.cast("string"), F.lit(":"), part)


def _half_keys(word: Column, sizes: Column) -> Column:
    """Shards of the halves for dictionary words of these lengths."""
    return F.flatten(F.transform(sizes, lambda x: F.array(_key("<", x, F.substring(word, F.lit(1), _front(x))), _key(">", x, F.right(word, _back(x))))))


def _piece_keys(word: Column, sizes: Column, moves: tuple[int, ...]) -> Column:
    """Shards of the three pieces for dictionary words of these lengths.

    The outer pieces stand at the word's ends. The middle one is needed if either side of it has one
    edit: the first one moves it by one of ``moves``, and both account for the difference of the lengths.
    """
    n = F.length(word)

    def keys(x: Column) -> Column:
        outer = _outer(x)
        shifts = F.filter(F.array(*(F.lit(s) for s in moves)), lambda s: F.abs(n - x - s) <= 1)
        middle = F.transform(shifts, lambda s: _key("|", x, F.substring(word, outer + 2 + s, x - 2 * outer - 2)))
        return F.concat(F.array(_key("[", x, F.substring(word, F.lit(1), outer)), _key("]", x, F.right(word, outer))), middle)

    return F.flatten(F.transform(sizes, keys))


def _shards(words: DataFrame, word: str, shard: str, reach: int, most: int, by: str | None) -> DataFrame:
    """One row a word and shard; ``reach``: how far the length of a partner may be from the own one, 0 for the dictionary."""
    w, n = F.col(word), F.length(word)
    if by:
        return words.where(n >= SHORTEST).select(word, F.col(by).alias(shard))
    sizes = lambda k: F.filter(F.sequence(n - k, n + k), lambda x: x >= SHORTEST)
    if most < 2:
        keys = _half_keys(w, sizes(min(reach, 1)))
    elif reach:
        keys = F.when(n < TWO_EDITS, _half_keys(w, sizes(1))).otherwise(_piece_keys(w, sizes(reach), (-1, 0, 1)))
    else:
        # words that allow one edit only reach up to TWO_EDITS letters
        keys = F.concat(F.when(n <= TWO_EDITS, _half_keys(w, sizes(0))).otherwise(F.array().cast("array<string>")), _piece_keys(w, sizes(0), (0,)))
    return words.where(n >= SHORTEST).select(word, F.explode(F.array_distinct(keys)).alias(shard))


def _join(probes: pd.DataFrame, words: pd.DataFrame, most: int, by: bool) -> pd.DataFrame:
    """Pairs of all shards of one task."""
    out: list[tuple[str | None, str, str, int]] = []
    if len(probes) and len(words):
        entries: dict[str, list[str]] = {}
        for shard, v in zip(words["w_shard"].tolist(), words["entry"].tolist()):
            entries.setdefault(shard, []).append(v)
        asked: dict[str, list[str]] = {}
        for shard, w in zip(probes["p_shard"].tolist(), probes["word"].tolist()):
            if shard in entries:
                asked.setdefault(shard, []).append(w)
        for shard, own in asked.items():
            back = not by and shard[0] in ">]"
            turn = (lambda x: x[::-1]) if back else (lambda x: x)
            group = shard if by else None
            root = trie([turn(v) for v in entries[shard]])
            for w in own:
                out += [(group, w, turn(v), d) for v, d in near(turn(w), root, allowed(w, most)) if d]
    return pd.DataFrame(out, columns=["by", "probe", "word", "distance"]).astype({"distance": "int32"})


def _less(word: Column, at: Column) -> Column:
    """The word without its letter at a place; whole at 0."""
    return F.when(at == 0, word).otherwise(F.concat(F.substring(word, F.lit(1), at - 1), F.substring(word, at + 1, F.length(word))))


def _one_edit(p: DataFrame, w: DataFrame, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """``probe, word, distance`` of distinct words that are equal or one edit apart; words below three letters are near themselves only.

    Words of both columns are one list, that is dealt out once by the hash of what is left of them;
    the rests themselves are taken from the words again. Of ``part`` (k, n) only those meet whose hash is k modulo n.
    """
    n, marks = F.length("word"), F.col("marks")
    sides = p.select("word", F.lit(2).alias("side")).unionByName(w.select(F.col("entry").alias("word"), F.lit(1).alias("side")))
    words = sides.distinct().groupBy("word").agg(F.sum("side").cast("int").alias("side"))
    at = F.explode(F.when(n >= SHORTEST, F.sequence(F.lit(0), n)).otherwise(F.array(F.lit(0))))
    rests = words.select("word", "side", at.alias("at")).select(F.xxhash64(_less(F.col("word"), F.col("at"))).alias("key"), "word", (4 * F.col("at") + F.col("side")).alias("marks"))
    if part[1] > 1:
        rests = rests.where(F.pmod("key", F.lit(part[1])) == part[0])
    a, b = (rests.select("key", F.col("word").alias(f"word_{k}"), marks.alias(f"marks_{k}")) for k in "ab")
    (x, y), (i, j) = (F.col("word_a"), F.col("word_b")), (F.shiftright("marks_a", 2), F.shiftright("marks_b", 2))
    # in one comparison, or it would be asked of either side before, and both sides would be shuffled
    asked = F.col("marks_a").bitwiseAND(2) + F.col("marks_b").bitwiseAND(1) == 3
    # one letter more, another letter at one place, or two neighbours swapped
    more = (i == 0) | (j == 0)
    other = (i == j) | (F.abs(i - j) == 1) & (F.substring(x, i, F.lit(1)) == F.substring(y, j, F.lit(1)))
    long = F.least(F.length(x), F.length(y)) >= SHORTEST
    equal = (x == y) & (i == 0) & (j == 0)
    near = a.join(b, "key").where(asked & (equal | (x != y) & long & (more | other) & (_less(x, i) == _less(y, j))))
    return near.select(x.alias("probe"), y.alias("word"), F.when(x == y, 0).otherwise(1).alias("distance"))


def near_words(probes: DataFrame, words: DataFrame, most: int = 2, limit: int = SHARD_WORDS, by: str | None = None, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """``probe, word, distance`` for all words (column ``word`` of both) within ``most`` edits (at most two), or
    as many as are ``allowed`` for the probe; each pair once. With ``by`` (a string column of both) also
    ``by``: only words of equal ``by`` meet, each pair once for each of them.

    Both sides are made distinct first. Null and empty words match nothing, nor does a null ``by``.
    For one edit without ``by`` a ``part`` (k, n) is the k-th of n shares of the work, from 0; all
    shares together have all pairs, some of them in two shares.
    """
    group = [by] if by else []
    p = probes.select("word", *group).where("word <> ''").distinct()
    w = words.select(F.col("word").alias("entry"), *(F.col(g).alias("w_by") for g in group)).where("entry <> ''").distinct()
    if most == 1 and not by:
        found = _one_edit(p.where(F.length("word") <= LONG_WORD), w.where(F.length("entry") <= LONG_WORD), part)
        if part[0] == 0:
            found = found.unionByName(_by_tries(p.where(F.length("word") >= LONG_WORD), w.where(F.length("entry") >= LONG_WORD), most, limit, None))
    else:
        found = _by_tries(p, w, most, limit, by)
    if by:
        return found.withColumnRenamed("by", by) if by != "by" else found  # a shard a group: each pair is found once
    return found.groupBy("probe", "word").agg(F.min("distance").alias("distance"))


def _by_tries(p: DataFrame, w: DataFrame, most: int, limit: int, by: str | None) -> DataFrame:
    """Pairs of distinct probes (``word``) and words (``entry``), with ``by`` of the group if there is one, else some of them more than once."""
    on = F.col("word") == F.col("entry")
    own = F.col(by) if by else F.lit(None).cast("string")
    exact = p.join(w, on & (F.col(by) == F.col("w_by")) if by else on).select(own.alias("by"), F.col("word").alias("probe"), F.col("entry").alias("word"), F.lit(0).alias("distance"))
    ps, ws = _shards(p, "word", "p_shard", most, most, by), _shards(w, "entry", "w_shard", 0, most, "w_by" if by else None)
    tasks = 2 * int(p.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # how many pieces each shard is cut into, on either side
    sizes = ws.select(F.col("w_shard").alias("shard"), F.lit(1).alias("w"), F.lit(0).alias("p")).unionByName(ps.select(F.col("p_shard").alias("shard"), F.lit(0).alias("w"), F.lit(1).alias("p")))
    sizes = sizes.groupBy("shard").agg(F.ceil(F.sum("w") / limit).cast("int").alias("n_words"), F.ceil(F.sum("p") / limit).cast("int").alias("n_probes"))
    # only shards of both sides, and of those that are cut the numbers of pieces
    pieces = sizes.where("n_words > 0 and n_probes > 0")

    def cut(rows: DataFrame, word: str, shard: str, own: str, others: str, names: tuple[str, str]) -> DataFrame:
        near = rows.join(pieces, F.col(shard) == F.col("shard"))
        return near.select(F.pmod(F.hash(shard), F.lit(tasks)).alias(f"{shard[0]}_task"), shard, word, F.pmod(F.hash(word), F.col(own)).alias(names[0]), F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(names[1]))

    cut_probes = cut(ps, "word", "p_shard", "n_probes", "n_words", ("p_own", "p_other"))
    cut_words = cut(ws, "entry", "w_shard", "n_words", "n_probes", ("w_own", "w_other"))
    close = (
        # the rows are few bytes and much work: partitions of this number are not coalesced
        cut_probes.repartition(tasks, "p_task", "p_own", "p_other").groupBy("p_task", "p_own", "p_other")
        .cogroup(cut_words.repartition(tasks, "w_task", "w_other", "w_own").groupBy("w_task", "w_other", "w_own"))
        .applyInPandas(lambda x, y: _join(x, y, most, bool(by)), "by string, probe string, word string, distance int")
    )
    found = exact.unionByName(close)
    return found if by else found.drop("by")
