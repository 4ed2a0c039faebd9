"""Encoding of a corpus with a byte-level BPE vocabulary, as a bounded-lookahead transducer.

Every text is read in windows. Tokens are emitted as soon as they are stable, which is the case

* for all text before the last white space that follows a non-space: no token of the pre-tokenizer's
  pattern holds a space after a non-space, so a look ahead of one character is enough there;
* in a run without white space, for all pre-tokens that end before the open end: what follows can
  change only a pre-token that touches the end, or an apostrophe less than three characters before it; and
* inside a single long pre-token, for the tokens that every continuation shares. With BPE the
  encoding of a prefix without its last token is the encoding of the shorter prefix, so the
  encodings of all prefixes form a tree. A token ends at most ``lookahead`` bytes after it began
  (worked out from the merge list: its longest product), so only the tree's last ``lookahead`` ends
  can grow, and what lies before their common ancestor is final.

So memory is constant whatever the length of a text, also of one pre-token. The merges between two
stable borders are done by the library's encoder; those of a long pre-token by the transducer.

``decode`` is the way back: an incremental state machine from bytes to text.
"""

from __future__ import annotations

import base64
import codecs
import functools
import os
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from stemma.session import fed

VOCABULARY = "byte_bpe_50k.tiktoken"
FOLDER = "/opt/tokenizers"
#: Fixed value: the pre-tokenizer's pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WINDOW = 1 << 12
LONG = 1 << 12  # bytes of a pre-token from which it is streamed


def vocabulary_path(name: str = VOCABULARY, folder: str | None = None) -> str:
    """The vocabulary's file: in ``folder``, else in the installed package of public tokenizers."""
    if folder:
        return os.path.join(folder, name)
    try:
        import public_tokenizers

        return str(public_tokenizers.path(name))
    except ImportError:
        return os.path.join(FOLDER, name)


_SPACE, _LETTER, _NUMBER, _OTHER = (regex.compile(p) for p in (r"\s+", r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+"))
_SPACE_AFTER = regex.compile(r"(?r)(?<=\S)\s")
#: Characters of the longest contraction of the pattern, which decide what an apostrophe begins.
_CONTRACTION = 3


class _Pretoken:
    """One pre-token that is given piece by piece."""

    def __init__(self, transducer: Transducer):
        self.t = transducer
        self.text = bytearray()
        # ends: position -> (last token, position before it); ``base`` is the end of what was emitted
        self.ends: dict[int, tuple[int, int]] = {0: (-1, 0)}
        self.base = self.at = 0

    def push(self, chunk: bytes) -> Iterator[int]:
        t, ends, text = self.t, self.ends, self.text
        text += chunk
        while self.at < self.base + len(text):
            self.at += 1
            at = self.at
            for size, token in t._endings(text, at - self.base):
                if at - size not in ends:
                    continue
                before = ends[at - size][0]
                if before < 0 or t._beside(before, token):
                    ends[at] = (token, at - size)
                    break
            else:
                raise ValueError("a byte without a token")
            if at % 256 == 0 and at - self.base > 4 * t.lookahead:
                root = self._ancestor()
                if root > self.base:
                    path = self._path(root)
                    yield from path
                    del text[: root - self.base]
                    ends = self.ends = {p: v for p, v in ends.items() if p > root}
                    ends[root] = (path[-1], root)
                    self.base = root

    def close(self) -> Iterator[int]:
        yield from self._path(self.at)

    def _ancestor(self) -> int:
        """The last end that all ends which can still grow go back to."""
        live = {p for p in range(max(self.base, self.at - self.t.lookahead + 1), self.at + 1) if p in self.ends}
        while len(live) > 1:
            p = max(live)
            live.discard(p)
            live.add(self.ends[p][1] if p > self.base else self.base)
        return live.pop()

    def _path(self, p: int) -> list[int]:
        out = []
        while p > self.base:
            token, p = self.ends[p]
            out.append(token)
        return out[::-1]


class Transducer:
    """Streaming encoder over one vocabulary."""

    def __init__(self, path: str, window: int = WINDOW, long: int = LONG):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self.lookahead = max(map(len, self.ranks))
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.window, self.long = window, max(long, 2 * self.lookahead)
        self._cut: dict[int, tuple[int, int] | None] = {}
        self._known: dict[tuple[int, int], bool] = {}
        self._backwards: dict | None = None
        self._long_run = regex.compile(rf"\S{{{max(1, self.long // 4)}}}|\s{{{max(1, self.long // 4)}}}")
        #: Characters held at once so far, at most.
        self.most_held = 0

    # -- inside one long pre-token

    def _parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; none for a single byte."""
        if token not in self._cut:
            raw = self.bytes_of[token]
            if len(raw) == 1:
                self._cut[token] = None
            else:
                pieces = [raw[i : i + 1] for i in range(len(raw))]
                while len(pieces) > 2:
                    best = min(range(len(pieces) - 1), key=lambda i: self.ranks.get(pieces[i] + pieces[i + 1], 1 << 60))
                    pieces[best : best + 2] = [pieces[best] + pieces[best + 1]]
                self._cut[token] = (self.ranks[pieces[0]], self.ranks[pieces[1]])
        return self._cut[token]

    def _beside(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens apart when they stand side by side."""
        known = self._known.get((left, right))
        if known is None:
            if len(self._known) > 1 << 20:
                self._known.clear()
            known = self._known[left, right] = self._stay(left, right)
        return known

    def _endings(self, text: bytearray, end: int) -> list[tuple[int, int]]:
        """Size and id of the tokens that end there, the longest first (a trie over reversed tokens)."""
        if self._backwards is None:
            self._backwards = {}
            for raw, token in self.ranks.items():
                node = self._backwards
                for byte in reversed(raw):
                    node = node.setdefault(byte, {})
                node[-1] = token
        found, node, i = [], self._backwards, end
        while i > 0:
            i -= 1
            node = node.get(text[i])
            if node is None:
                break
            if -1 in node:
                found.append((end - i, node[-1]))
        return found[::-1]

    def _stay(self, left: int, right: int) -> bool:
        limit = 1 << 60
        a, b = left, right
        while True:
            merged = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if merged is not None and merged < limit:
                return False
            if a > b:
                limit = a
                cut = self._parts(a)
                if cut is None:
                    return True
                a = cut[1]
                if a == limit:
                    return True
            else:
                limit = b + 1
                cut = self._parts(b)
                if cut is None:
                    return True
                b = cut[0]

    def stream_bytes(self, chunks: Iterable[bytes]) -> Iterator[int]:
        """Tokens of one pre-token that is given piece by piece, each as soon as it is final."""
        run = _Pretoken(self)
        for chunk in chunks:
            yield from run.push(chunk)
        yield from run.close()

    # -- whole texts

    def _whole(self, piece: str) -> Iterator[int]:
        raw = piece.encode("utf-8", "replace")
        if len(raw) <= self.long:
            yield from self.encoding.encode_ordinary(piece)
        else:
            yield from self.stream_bytes(raw[i : i + self.long] for i in range(0, len(raw), self.long))

    def _stable(self, text: str) -> Iterable[int]:
        """Tokens of text between two stable borders. Long pre-tokens are streamed."""
        if self._long_run.search(text) is None:
            return self.encoding.encode_ordinary(text)
        return chain.from_iterable(self._whole(m.group()) for m in self.pattern.finditer(text))

    def encode(self, text: str | None) -> list[int]:
        """Ids of the text without special tokens; an empty or null text gives none."""
        if not text:
            return []
        return list(self.stream(text[i : i + self.window] for i in range(0, len(text), self.window)))

    def stream(self, windows: Iterable[str]) -> Iterator[int]:
        """Ids of a text that is given window by window."""
        held, run, kind = "", None, None
        for w in windows:
            held += w
            self.most_held = max(self.most_held, len(held))
            if run is not None:
                held, tokens, over = self._continued(held, run, kind)
                yield from tokens
                if not over:
                    continue
                yield from run.close()
                run = None
            cut = self._last_border(held)
            if cut:
                yield from self._stable(held[:cut])
                held = held[cut:]
            if len(held) > self.long:  # one open pre-token
                run = _Pretoken(self)
                kind = self._kind(held)
                lead = held[:1] if kind is not _SPACE and held[0] == " " else ""
                yield from run.push(lead.encode())
                held, tokens, _ = self._continued(held[len(lead) :], run, kind)
                yield from tokens
        if run is not None:
            yield from run.push(held.encode("utf-8", "replace"))
            yield from run.close()
        elif held:
            yield from self._stable(held)

    @staticmethod
    def _kind(held: str) -> regex.Pattern:
        """Characters that an open pre-token goes on with."""
        first = held[1] if held[0] == " " and not held[1].isspace() else held[0]
        return next(k for k in (_SPACE, _LETTER, _NUMBER, _OTHER) if k.match(first))

    @staticmethod
    def _continued(held: str, run: _Pretoken, kind: regex.Pattern) -> tuple[str, list[int], bool]:
        """What is still held, the tokens that became final, and whether the pre-token is over.

        The last of a run of white space belongs to what follows it, if anything does.
        """
        m = kind.match(held)
        end = m.end() if m else 0
        over = end < len(held)
        if kind is _SPACE:
            end = max(0, end - 1)
        return held[end:], list(run.push(held[:end].encode("utf-8", "replace"))), over

    def _last_border(self, text: str) -> int:
        """Place before which all pre-tokens are final; 0 if there is none."""
        cut = 0
        for m in _SPACE_AFTER.finditer(text):
            cut = m.start()
            break
        if len(text) - cut <= self.long:
            return cut
        tail = text[cut:]
        for m in self.pattern.finditer(tail):
            if m.end() == len(tail) or m.start() + _CONTRACTION > len(tail):
                break
            end = m.end()
        else:
            return cut
        return cut + end if m.start() else cut

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text of the ids, as far as their bytes are whole characters."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for token in ids:
            piece = machine.decode(self.bytes_of[token])
            if piece:
                yield piece
        tail = machine.decode(b"", True)
        if tail:
            yield tail


@functools.lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    """One transducer a worker and vocabulary."""
    return Transducer(path)


def encoded(documents: DataFrame, text: str = "text", key: str = "doc_id", path: str | None = None) -> DataFrame:
    """``key`` and ``ids`` of every document, where it stands; nothing is shuffled.

    An empty and a null text give an empty list, a repeated row is repeated, other columns are dropped.
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(path)
        for b in batches:
            ids = pa.array([t.encode(x) for x in b.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], [key, "ids"])

    kind = dict(documents.dtypes)[key]
    return fed(documents.select(key, text)).mapInArrow(run, f"{key} {kind}, ids array<int>")


def decoded(tokens: DataFrame, key: str = "doc_id", path: str | None = None) -> DataFrame:
    """``key`` and ``text`` of encoded documents; no ids, and null, give an empty text."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(path)
        for b in batches:
            texts = pa.array(["".join(t.decode(x or ())) for x in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), texts], [key, "text"])

    kind = dict(tokens.dtypes)[key]
    return tokens.select(key, "ids").mapInArrow(run, f"{key} {kind}, text string")
