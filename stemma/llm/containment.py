"""Evaluation texts leaking into a corpus: size-partitioned MinHash containment search.

Test items are short and documents long, so their Jaccard similarity says little. Items are
therefore partitioned by their number of shingles, and for each partition a document is looked at in
windows of the partition's size, made of two blocks each, whose MinHash is the minimum of the blocks'
MinHashes. A window and an item whose signatures agree in a few places are a candidate. Candidates
are verified by exact shingle containment, then word by word: at least half of the item's words must
stand in their order in one or two passages of the document, where single words may be changed.

Shingles are of two words here, not five: single words of a leaked item may be changed, and TESTDATA
asks for half of an item only, so five words in a row are often not left.

Words are numbered by the items' vocabulary, so a shingle that no item has is known by a look-up, and
a document without two shingles of the items goes no further. Of the others only shingles that some
item has are hashed: what is in no item cannot make a window more like one.

Documents are never shuffled. Items are shipped to them in blocks of a bounded size, one block after
the other.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.session import fed, written

HASHES = 128
#: Items, and characters of them, that are shipped at once; more are searched for in further passes.
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 1 << 23
SHARE = 0.5
AGREE = 3
SHINGLE_SHARE = 0.15
GAP = 5
LEAST_PASSAGE = 4
_CHUNK_WORDS = 1 << 15
_BITMAP = 22  # bits of the number of slots that say which shingles some item has

_BROKEN = re.compile(r"(?<=\w)-[ \t]*\r?\n\s*(?=\w)")
_INNER = re.compile(r"(?<=\w)[-‐‑’'­​](?=\w)")
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    """Words in lower case; hyphens and apostrophes inside a word, also at a line's end, fall away."""
    if not text:
        return []
    return _WORD.findall(_INNER.sub("", _BROKEN.sub("", text)).casefold())


def held_words(item: list[str], doc: list[str], gap: int = GAP, least: int = LEAST_PASSAGE) -> int:
    """Item words that the document holds in their order in its best one or two passages.

    A passage is a chain of equal words, in order in both texts, with fewer than ``gap`` other
    words between two of them; chains of fewer than ``least`` words are common phrases.
    """
    at: dict[str, list[int]] = {}
    for i, w in enumerate(item):
        at.setdefault(w, []).append(i)
    pairs = [(j, i) for j, w in enumerate(doc) for i in at.get(w, ())]
    found = 0
    used_items: set[int] = set()
    used_words: set[int] = set()
    for _ in range(2):
        live = [(j, i) for j, i in pairs if i not in used_items and j not in used_words]
        best: list[float] = []
        size: list[int] = []
        back: list[int] = []
        top, first = -1, 0
        for p, (j, i) in enumerate(live):
            while live[first][0] < j - gap:
                first += 1
            score, count, prev = 1.0, 1, -1
            for q in range(p - 1, first - 1, -1):
                jq, iq = live[q]
                if jq < j and iq < i and i - iq <= gap:
                    s = best[q] + 1 - 0.2 * (max(i - iq, j - jq) - 1)
                    if s > score:
                        score, count, prev = s, size[q] + 1, q
            best.append(score)
            size.append(count)
            back.append(prev)
            if top < 0 or score > best[top]:
                top = p
        if top < 0 or size[top] < least:
            break
        found += size[top]
        while top >= 0:
            used_words.add(live[top][0])
            used_items.add(live[top][1])
            top = back[top]
    return found


class ItemIndex:
    """Vocabulary, shingles and signatures, by size partition, of a bounded block of items."""

    def __init__(self, items: tuple[tuple[int, str], ...], hashes: int = HASHES):
        rng = np.random.default_rng(20240229)
        self.a = rng.integers(1, 1 << 62, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 62, hashes, dtype=np.uint64)
        self.hashes = hashes
        self.ids = np.array([i for i, _ in items], np.int64)
        self.words = [words(t) for _, t in items]
        self.number: dict[str, int] = {}
        for own in self.words:
            for w in own:
                self.number.setdefault(w, len(self.number))
        self.shingles = [np.unique(self.pairs(self.numbered(w))) for w in self.words]
        self.sets = [frozenset(s.tolist()) for s in self.shingles]
        self.known = np.unique(np.concatenate([*self.shingles, np.zeros(0, np.int64)]))
        self.bitmap = np.zeros(1 << _BITMAP, bool)
        self.bitmap[self._slot(self.known)] = True
        parts: dict[int, list[int]] = {}
        for n, s in enumerate(self.shingles):
            if len(s):
                parts.setdefault(self.partition(len(s)), []).append(n)
        self.parts = {size: self._table(own) for size, own in sorted(parts.items())}

    @staticmethod
    def partition(n: int) -> int:
        """Upper bound of the size partition: 8, 12, 18, 27, 40, 60, ..."""
        size = 8
        while size < n:
            size = size * 3 // 2
        return size

    def numbered(self, w: list[str]) -> np.ndarray:
        """Numbers of the words in the items' vocabulary, -1 for those that are in no item."""
        return np.fromiter(map(self.number.get, w, repeat(-1)), np.int64, len(w))

    def pairs(self, n: np.ndarray) -> np.ndarray:
        """Codes of the shingles of two words; -1 if a word is in no item."""
        if len(n) < 2:
            return np.zeros(0, np.int64)
        return np.where((n[:-1] < 0) | (n[1:] < 0), -1, n[:-1] * np.int64(len(self.number)) + n[1:])

    @staticmethod
    def _slot(shingles: np.ndarray) -> np.ndarray:
        return (shingles.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITMAP)

    def places(self, shingles: np.ndarray) -> np.ndarray:
        """Places of the shingles that some item has."""
        if not len(self.known):
            return np.zeros(0, np.int64)
        some = np.flatnonzero(self.bitmap[self._slot(shingles)])
        at = np.minimum(np.searchsorted(self.known, shingles[some]), len(self.known) - 1)
        return some[self.known[at] == shingles[some]]

    def mins(self, shingles: np.ndarray) -> np.ndarray:
        """Matrix of hash values, one row a hash function."""
        x = shingles.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        return ((x[None, :] * self.a[:, None] + self.b[:, None]) >> np.uint64(32)).astype(np.uint32)

    def _table(self, own: list[int]) -> tuple[np.ndarray, np.ndarray]:
        keys, item = [], []
        slot = np.arange(self.hashes, dtype=np.uint64) << np.uint64(32)
        for n in own:
            keys.append(slot | self.mins(self.shingles[n]).min(axis=1).astype(np.uint64))
            item.append(np.full(self.hashes, n))
        k, i = np.concatenate(keys), np.concatenate(item)
        order = np.argsort(k, kind="stable")
        return k[order], i[order]

    def candidates(self, shingles: list[np.ndarray], places: list[np.ndarray], agree: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (by their order) and items whose signatures agree in some window.

        ``places``: where each document's ``shingles`` are those of items.
        """
        out: set[int] = set()
        if not sum(map(len, places)):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        values = self.mins(np.concatenate([s[p] for s, p in zip(shingles, places)]))
        owner = np.repeat(np.arange(len(places)), [len(p) for p in places])
        at = np.concatenate(places)
        for size, (keys, item) in self.parts.items():
            block = at // max(4, size // 2)
            first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (block[1:] != block[:-1])))
            doc, nth = owner[first], block[first]
            low = np.minimum.reduceat(values, first, axis=1)
            # windows of two blocks in a row, and each block alone, as beside an empty one
            beside = np.flatnonzero((doc[1:] == doc[:-1]) & (nth[1:] == nth[:-1] + 1))
            count = np.diff(np.append(first, len(at)))
            # an item of this partition needs a tenth of ``size`` shingles in two passages, so a twentieth in one
            need = max(2, -(-size // 20))
            alone, both = np.flatnonzero(count >= need), beside[count[beside] + count[beside + 1] >= need]
            if not len(alone) + len(both):
                continue
            window = np.concatenate([low[:, alone], np.minimum(low[:, both], low[:, both + 1])], axis=1)
            doc = np.append(doc[alone], doc[both])
            probe = (np.arange(self.hashes, dtype=np.uint64)[:, None] << np.uint64(32)) | window
            probe = probe.ravel()
            lo = np.searchsorted(keys, probe)
            hit = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == probe)
            if not len(hit):
                continue
            hi = np.searchsorted(keys, probe[hit], side="right")
            lo = lo[hit]
            n = hi - lo
            w = np.repeat(hit % window.shape[1], n)
            it = item[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            code, count = np.unique(w * np.int64(len(self.ids)) + it, return_counts=True)
            code = code[count >= agree]
            out.update((doc[code // len(self.ids)] * np.int64(len(self.ids)) + code % len(self.ids)).tolist())
        found = np.array(sorted(out), np.int64)
        return found // len(self.ids), found % len(self.ids)


@functools.lru_cache(maxsize=2)
def _index(items: tuple[tuple[int, str], ...], hashes: int) -> ItemIndex:
    return ItemIndex(items, hashes)


def search(index: ItemIndex, texts: list[str | None], agree: int = AGREE, shingle_share: float = SHINGLE_SHARE, share: float = SHARE) -> Iterator[tuple[int, int, int]]:
    """``(document, item, held words)``, documents and items by their order."""
    held: list[list[str]] = []
    first = 0

    def flush() -> Iterator[tuple[int, int, int]]:
        sh = [index.pairs(index.numbered(w)) for w in held]
        places = [index.places(s) for s in sh]
        docs, items = index.candidates(sh, [p if len(p) > 1 else p[:0] for p in places], agree)
        at, there = -1, frozenset()
        for d, n in zip(docs.tolist(), items.tolist()):
            if d != at:
                at, there = d, frozenset(sh[d][places[d]].tolist())
            own = index.sets[n]
            if len(own & there) < max(2, shingle_share * len(own)):
                continue
            count = held_words(index.words[n], held[d])
            if count >= share * len(index.words[n]):
                yield first + d, n, count

    size = 0
    for i, t in enumerate(texts):
        held.append(words(t))
        size += len(held[-1])
        if size >= _CHUNK_WORDS:
            yield from flush()
            held, size, first = [], 0, i + 1
    if held:
        yield from flush()


def leaks(documents: DataFrame, items: DataFrame, block: int = BLOCK_ITEMS, chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, held_words, item_words`` of each document that holds half of an item.

    Null, empty and blank texts hold nothing; an item of one word or none is in no document. A
    document or item delivered twice under one id counts once.
    """
    own = items.select("item_id", "text").where("text is not null")
    n, total = own.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block), -(-total // chars))
    if blocks == 1:
        found = _searched(documents, _chosen(own))
    else:  # one after the other, so that one block at a time is held
        found = reduce(DataFrame.unionByName, [written(_searched(documents, _chosen(own.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == n))), "leaks") for n in range(blocks)])
    return found.dropDuplicates(["doc_id", "item_id"])


def _chosen(items: DataFrame) -> tuple[tuple[int, str], ...]:
    """The items of one block, which is of a bounded size."""
    return tuple(sorted({(r.item_id, r.text) for r in items.toLocalIterator()}))


def _searched(documents: DataFrame, chosen: tuple[tuple[int, str], ...]) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(chosen)  # at most one block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(shared.value, HASHES) if shared.value else None
        for b in batches:
            rows = list(search(index, b.column(1).to_pylist())) if index else []
            d = np.array([r[0] for r in rows], np.int64)
            ids = b.column(0).take(pa.array(d, pa.int64())).cast(pa.int64())
            item = pa.array([int(index.ids[n]) for _, n, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, item, pa.array([c for _, _, c in rows], pa.int32()), pa.array([len(index.words[n]) for _, n, _ in rows], pa.int32())],
                ["doc_id", "item_id", "held_words", "item_words"],
            )

    return fed(documents.select("doc_id", "text").where("text is not null")).mapInArrow(run, "doc_id bigint, item_id bigint, held_words int, item_words int")
