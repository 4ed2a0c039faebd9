"""Several values packed in one field: one row a value, with its position.

A batch's strings are looked at as one Arrow buffer of bytes. Masks over all bytes mark quotes
(by parity), parentheses (by depth), delimiters and list marks; the places left as delimiters give
the child offsets, the children are trimmed by moving their bounds, and the child column is built
as an Arrow list array and flattened with its parents' ordinals. No loop runs over rows or
characters; only values with JSON escapes beyond a quote are finished one by one.

What counts as a delimiter outside quotes and parentheses: ``, ; | tab newline`` and their
full-width and CJK forms, bullets, a middle dot, ``<br>``, a slash with white space on both sides,
and list numbers that count up from 1.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

_ONE = b",;|\t\n\r\x0b\x0c"
_MANY = tuple(x.encode() for x in ("，", "；", "、", "｜", "•", "●", "▪", "‣", "·", "・", "\u0085", "\u2028", "\u2029"))
# every other wide white space of Unicode, and what has no width
_SPACES = tuple(c.encode() for c in map(chr, range(0x80, 0x3001)) if c.isspace() and c.encode() not in _MANY) + tuple(x.encode() for x in ("\u200b", "\u2060", "\ufeff"))
_LEADING = tuple(x.encode() for x in ("“", "‘", "«"))
_TRAILING = tuple(x.encode() for x in ("”", "’", "»"))


def _at(buf: np.ndarray, pattern: bytes) -> np.ndarray:
    """Mask of the places where the pattern begins."""
    n = len(buf)
    hit = np.zeros(n, bool)
    k = len(pattern)
    if n >= k:
        m = buf[: n - k + 1] == pattern[0]
        for i in range(1, k):
            m &= buf[i : n - k + 1 + i] == pattern[i]
        hit[: n - k + 1] = m
    return hit


def _all_bytes(buf: np.ndarray, wide: np.ndarray, pattern: bytes) -> np.ndarray:
    """Places of all bytes of the pattern, which begins at one of ``wide`` (places that begin a character beyond ASCII)."""
    at = wide[buf[wide] == pattern[0]]
    for i in range(1, len(pattern)):
        at = at[at + i < len(buf)]
        at = at[buf[at + i] == pattern[i]]
    return (at[:, None] + np.arange(len(pattern))).ravel()


def _shift(mask: np.ndarray, by: int, fill: bool = False) -> np.ndarray:
    """``mask`` seen from ``by`` places later (by > 0: the value of an earlier place)."""
    out = np.full(len(mask), fill)
    if by > 0:
        out[by:] = mask[:-by]
    elif by < 0:
        out[:by] = mask[-by:]
    else:
        out[:] = mask
    return out


def _row_parity(toggles: np.ndarray, row: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Toggles before each place within its row, and each place's row total."""
    total = np.cumsum(toggles)
    before = total - toggles
    base = before[first]
    ends = np.append(first[1:], len(toggles)) - 1
    return before - base[row], (total[ends] - base)[row]


def _paired(opens: np.ndarray, closes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only those opening marks whose next mark in the row closes, with these closing marks."""
    places = np.flatnonzero(opens | closes)
    o, c = np.zeros(len(opens), bool), np.zeros(len(opens), bool)
    if len(places) > 1:
        is_open = opens[places] & ~closes[places]
        is_close = closes[places] & ~opens[places]
        good = is_open[:-1] & is_close[1:] & (row[places[:-1]] == row[places[1:]])
        o[places[:-1][good]] = True
        c[places[1:][good]] = True
    return o, c


def _balanced(opens: np.ndarray, closes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only those opening and closing marks that have a partner in their row, however deep they nest."""
    places = np.flatnonzero(opens | closes)
    step = np.where(opens[places], 1, -1)
    for turn in (1, -1):  # closing marks without an opening one, then, from the end, the other way round
        p, d = places[::turn], step[::turn] * turn
        r = row[p]
        if not len(p):
            break
        new = np.append(True, r[1:] != r[:-1])
        total = np.cumsum(d)
        level = total - (total - d)[np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))]
        group = np.cumsum(new) - 1
        span = 2 * len(p) + 2
        least = np.minimum.accumulate(np.minimum(level, 0) - group * span) + group * span
        before = np.where(new, 0, np.append(0, least[:-1]))
        lone = (d < 0) & (level < before)
        places, step = p[~lone][::turn], step[::turn][~lone][::turn]
    o, c = np.zeros(len(opens), bool), np.zeros(len(opens), bool)
    o[places[step > 0]] = True
    c[places[step < 0]] = True
    return o, c


def _in_turn(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Of numbers in order of place: those that count up from 1 in their row, each the first that continues the count."""
    kept = np.zeros(len(row), bool)
    order = np.argsort(value, kind="stable")
    bounds = np.searchsorted(value[order], np.arange(1, len(row) + 2))
    last: dict[str, np.ndarray] = {"row": np.unique(row), "at": np.full(len(np.unique(row)), -1)}
    for v in range(1, len(row) + 1):
        at = np.sort(order[bounds[v - 1] : bounds[v]])
        i = np.searchsorted(last["row"], row[at])
        there = (i < len(last["row"])) & (last["row"][np.minimum(i, len(last["row"]) - 1)] == row[at]) if len(last["row"]) else np.zeros(len(at), bool)
        at, i = at[there], i[there]
        good = at > last["at"][i]
        rows, first = np.unique(row[at[good]], return_index=True)
        if not len(rows):
            break
        chosen = at[good][first]
        kept[chosen] = True
        last = {"row": rows, "at": chosen}
    return kept


def _numbering(buf: np.ndarray, row: np.ndarray, first: np.ndarray, space: np.ndarray, delim: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Mask of all bytes of list numbers (``1.``, ``1)``, ``(1)``) that count up from 1 in their row."""
    n = len(buf)
    digit = (buf >= 48) & (buf <= 57)
    start = np.zeros(n, bool)
    start[first] = True
    run_start = digit & ~(_shift(digit, 1) & ~start)
    s = np.flatnonzero(run_start)
    mask = np.zeros(n, bool)
    if not len(s):
        return mask
    length = np.ones(len(s), np.int64)
    value = (buf[s] - 48).astype(np.int64)
    for k in range(1, 18):  # as many digits as a count can have
        more = (s + k < n) & (length == k)
        i = np.minimum(s + k, n - 1)
        more &= digit[i] & (row[i] == row[s])
        value = np.where(more, value * 10 + buf[i] - 48, value)
        length += more
        if not more.any():
            break
    e = s + length
    inside = e < n
    ei = np.minimum(e, n - 1)
    same = inside & (row[ei] == row[s])
    dot = same & ((buf[ei] == 46) | (buf[ei] == 41))
    after = np.minimum(e + 1, n - 1)
    spaced = (e + 1 < n) & (row[after] == row[s]) & space[after]
    prev = np.maximum(s - 1, 0)
    has_prev = (s > 0) & (row[prev] == row[s])
    paren = has_prev & (buf[prev] == 40) & same & (buf[ei] == 41)
    b = np.where(paren, s - 1, s)
    bp = np.maximum(b - 1, 0)
    edge = (b == 0) | (row[bp] != row[s]) | space[bp] | delim[bp]
    ok = dot & spaced & edge & free[np.minimum(b, n - 1)] & free[s]
    s, e, b, value = s[ok], e[ok], b[ok], value[ok]
    turn = _in_turn(row[s], value)  # a number out of turn is no mark
    s, e, b, value = s[turn], e[turn], b[turn], value[turn]
    # the first number must open the cell
    if len(s):
        r = row[s]
        lead = np.cumsum(~(space | delim))
        at_start = lead[b] - lead[first[r]] + ~(space | delim)[first[r]] <= 1
        opened = np.zeros(len(first), bool)
        opened[r[(value == 1) & at_start]] = True
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, b[opened[r]], 1)
        np.add.at(change, e[opened[r]] + 1, -1)
        mask = np.cumsum(change[:-1]) > 0
    return mask


def split_values(cells: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """List array of each cell's values, and each value's parent (index into ``cells``).

    A null or blank cell gives an empty list.
    """
    cells = pc.fill_null(cells.cast(pa.large_string()), "")
    # each cell is ended by a newline, so that no mask looks into the next one
    joined = pc.binary_join_element_wise(cells, pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
    if isinstance(joined, pa.ChunkedArray):
        joined = joined.combine_chunks()
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    n_rows = len(joined)
    if not n_rows:
        return pa.array([], pa.list_(pa.string())), np.zeros(0, np.int64)
    buf = np.frombuffer(joined.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    first = (offsets[:-1] - offsets[0]).astype(np.int64)
    n = len(buf)
    row = np.repeat(np.arange(n_rows), np.diff(offsets))
    start = np.zeros(n, bool)
    start[first] = True
    end = np.append(start[1:], True)  # the closing newline of each cell

    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    wide_space = np.zeros(n, bool)
    wide = np.flatnonzero(buf >= 0xC2)
    if len(wide):
        for w in _SPACES:
            wide_space[_all_bytes(buf, wide, w)] = True
    space |= wide_space

    delim = np.isin(buf, np.frombuffer(_ONE, np.uint8))
    long = np.zeros(n, bool)
    for d in _MANY:
        hit = _at(buf, d)
        if d == "·".encode():
            hit &= _shift(space | start, 1, True) & _shift(space, -len(d))
        for i in range(len(d)):
            long |= _shift(hit, i)
    delim |= long
    # <br>, <br/>, <br /> in either case
    low = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)
    for tag in (b"<br>", b"<br/>", b"<br />"):
        hit = _at(low, tag)
        for i in range(len(tag)):
            delim |= _shift(hit, i)
    slash = (buf == 47) & _shift(space, 1) & _shift(space, -1)
    delim |= slash

    # brackets around a whole cell: JSON and array literals
    solid = ~space
    count = np.cumsum(solid)
    before = np.append(0, count)[first]
    has = np.append(count[first[1:] - 1], count[-1]) > before if n_rows > 1 else np.array([count[-1] > 0])
    places = np.flatnonzero(solid)
    json_row = np.zeros(n_rows, bool)
    if len(places):
        lead = places[np.minimum(before, len(places) - 1)]
        last = places[np.maximum(np.append(count[first[1:] - 1], count[-1]) - 1, 0)]
        square = has & (buf[lead] == 91) & (buf[last] == 93)
        curly = has & (buf[lead] == 123) & (buf[last] == 125)
        json_row = (square | curly) & (lead < last)
        delim[lead[json_row]] = True
        delim[last[json_row]] = True

    # double quotes by parity; an escaped one is none; an odd last one stands for itself
    quote = (buf == 34) & ~((_shift(buf == 92, 1)) & ~start)
    inside, total = _row_parity(quote.astype(np.int64), row, first)
    odd = quote & (total % 2 == 1) & (inside == total - 1)
    if odd.any():
        quote &= ~odd
        inside, _ = _row_parity(quote.astype(np.int64), row, first)
    quoted = (inside % 2 == 1) | quote

    opens, closes = np.zeros(n, bool), np.zeros(n, bool)
    for x, y in zip(_LEADING, _TRAILING):
        a, b = _paired(_at(buf, x) & ~quoted, _at(buf, y) & ~quoted, row)
        opens |= a
        closes |= b
    # single quotes: they open after an edge and close before one
    edge_before = _shift(space | delim | (buf == 40), 1) | start
    edge_after = _shift(space | delim, -1) | end
    tick = (buf == 39) & ~quoted
    a, b = _paired(tick & edge_before & ~_shift(space, -1), tick & edge_after & ~edge_before, row)
    opens |= a
    closes |= b
    depth = np.cumsum(opens.astype(np.int64)) - np.cumsum(closes.astype(np.int64))
    quoted |= (depth > 0) | closes

    marks = _numbering(buf, row, first, space, delim, ~quoted)

    up = (buf == 40) & ~quoted & ~marks
    down = (buf == 41) & ~quoted & ~marks
    up_, down_ = _balanced(up, down, row)
    depth = np.cumsum(up_.astype(np.int64)) - np.cumsum(down_.astype(np.int64))
    guarded = quoted | (depth > 0) | down_

    cut = ((delim & ~guarded) | marks | end) & ~(guarded & ~end)
    # pieces: maximal runs of uncut bytes
    keep = ~cut
    begin = np.flatnonzero(keep & (~_shift(keep, 1) | start))
    stop = np.flatnonzero(keep & (~_shift(keep, -1) | _shift(start, -1))) + 1
    return _children(buf, begin, stop, row[begin] if len(begin) else np.zeros(0, np.int64), space, json_row, n_rows)


def _moved(buf: np.ndarray, begin: np.ndarray, stop: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds without white space at either side."""
    places = np.flatnonzero(~space)
    before = np.append(0, np.cumsum(~space))
    some = before[stop] > before[begin]
    if len(places):
        b = np.where(some, places[np.minimum(before[begin], len(places) - 1)], stop)
        e = np.where(some, places[np.maximum(before[stop] - 1, 0)] + 1, stop)
    else:
        b, e = stop.copy(), stop.copy()
    return b, e


def _children(buf, begin, stop, parent, space, json_row, n_rows):
    begin, stop = _moved(buf, begin, stop, space)
    pad = np.append(buf, np.zeros(4, np.uint8))
    # bullets that open an item
    bullet = ((pad[begin] == 45) | (pad[begin] == 42) | (pad[begin] == 43)) & (stop - begin > 1)
    space_pad = np.append(space, np.ones(4, bool))
    bullet &= space_pad[begin + 1]
    lone = ((pad[begin] == 45) | (pad[begin] == 42)) & (stop - begin == 1)
    begin = np.where(bullet | lone, begin + 1, begin)
    begin, stop = _moved(buf, begin, stop, space)
    escaped = np.zeros(len(begin), bool)
    for _ in range(2):  # quotes around quotes
        size = stop - begin
        last = np.maximum(stop - 1, 0)
        double = (size > 1) & (pad[begin] == 34) & (pad[last] == 34) & ~escaped
        single = (size > 1) & (pad[begin] == 39) & (pad[last] == 39)
        escaped |= double
        begin = np.where(double | single, begin + 1, begin)
        stop = np.where(double | single, stop - 1, stop)
        for x, y in zip(_LEADING, _TRAILING):
            k = len(x)
            m = stop - begin >= 2 * k
            if len(y) != k:
                m &= stop - begin >= k + len(y)
            for i in range(k):
                m &= pad[np.minimum(begin + i, len(buf))] == x[i]
            for i in range(len(y)):
                m &= pad[np.maximum(stop - len(y) + i, 0)] == y[i]
            begin = np.where(m, begin + k, begin)
            stop = np.where(m, stop - len(y), stop)
        begin, stop = _moved(buf, begin, stop, space)
    some = stop > begin
    begin, stop, parent, escaped = begin[some], stop[some], parent[some], escaped[some]
    size = stop - begin
    offsets = np.append(0, np.cumsum(size)).astype(np.int64)
    take = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size) + np.repeat(begin, size)
    values = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.tobytes()), pa.py_buffer(buf[take].tobytes())).cast(pa.string())
    if escaped.any():
        e = pa.array(escaped)
        values = pc.if_else(e, pc.replace_substring(pc.replace_substring(values, '""', '"'), '\\"', '"'), values)
        deep = np.flatnonzero(escaped & json_row[parent] & pc.match_substring(values, "\\").to_numpy(zero_copy_only=False))
        if len(deep):
            items = values.to_pylist()
            for i in deep:
                try:
                    items[i] = json.loads('"' + items[i].replace('"', '\\"') + '"')
                except ValueError:
                    pass
            values = pa.array(items, pa.string())
    counts = np.bincount(parent, minlength=n_rows)
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), values)
    return lists, parent


def _flattened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists, parent = split_values(b.column(2))
        parents = pc.list_parent_indices(lists)
        at = np.asarray(lists.offsets)
        p = parents.to_numpy(zero_copy_only=False).astype(np.int64)
        position = (np.arange(len(p)) - at[p] + 1).astype(np.int32) if len(p) else np.zeros(0, np.int32)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(parents), b.column(1).take(parents), pa.array(position, pa.int32()), lists.flatten()],
            ["field_name", "row_id", "item_pos", "item"],
        )


def unpacked(cells: DataFrame) -> DataFrame:
    """``field_name, row_id, item_pos, item`` from ``field_name, row_id, cell``: one row a value.

    Null and blank cells, and empty pieces, give no row and take no position. Equal values in a cell
    stay apart. Rows are split where they stand: nothing is shuffled.
    """
    cells = cells.select("field_name", "row_id", "cell").where("cell is not null")
    return cells.mapInArrow(_flattened, "field_name string, row_id bigint, item_pos int, item string")
