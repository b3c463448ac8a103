"""Several values packed in one attribute value: one row for each, with its position.

The attribute strings of an Arrow batch are scanned as one byte buffer. Quote parity and
delimiter masks find the `key value` pairs, then the members of the wanted keys; their child
offsets make list arrays, which are flattened with the ordinals of their parents.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 4 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_MEMBER = np.zeros(256, bool)
_MEMBER[[*b"._:-'"]] = True
_MEMBER[48:58] = _MEMBER[65:91] = _MEMBER[97:123] = True
_DQ, _SQ, _SEMI = 34, 39, 59


def _next_true(mask: np.ndarray) -> np.ndarray:
    """For each place 0..n the next place >= it where `mask` holds, n if there is none."""
    n = len(mask)
    at = np.append(np.where(mask, np.arange(n), n), n)
    return np.minimum.accumulate(at[::-1])[::-1]


def _pairs(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, key start, key end, value start, value end) of each `key value` pair."""
    n = len(b)
    quotes = np.concatenate([[0], np.cumsum(b == _DQ)])
    row_at = np.repeat(np.arange(len(starts)), ends - starts)
    odd = (quotes[:-1] - np.repeat(quotes[starts], ends - starts)) % 2 == 1
    cut = np.flatnonzero((b == _SEMI) & ~odd)
    lo = np.concatenate([starts, cut + 1])
    hi = np.concatenate([ends, cut])
    row = np.concatenate([np.arange(len(starts)), row_at[cut]])
    order = np.lexsort((lo, row))
    lo, row = lo[order], row[order]
    hi = np.sort(hi)  # rows follow each other in the buffer, and so do their pieces
    filled, blank = _next_true(~_BLANK[b]), _next_true(_BLANK[b])
    ks = np.minimum(filled[lo], hi)
    ke = np.minimum(blank[ks], hi)
    vs = np.minimum(filled[ke], hi)
    back = np.maximum.accumulate(np.concatenate([[0], np.where(_BLANK[b], 0, np.arange(1, n + 1))]))
    ve = np.maximum(back[hi], vs)
    return row, ks, ke, vs, ve


def _spelled(b: np.ndarray, ks: np.ndarray, ke: np.ndarray, key: bytes) -> np.ndarray:
    same = ke - ks == len(key)
    at = np.where(same, ks, 0)
    for i, c in enumerate(key):
        same &= b[np.minimum(at + i, len(b) - 1)] == c
    return same


def _member_bytes(b: np.ndarray) -> np.ndarray:
    """Where the bytes of UTF-8 text belong to letters, digits or marks that a member may hold."""
    word = _MEMBER[b]
    if not len(b) or b.max() < 128:
        return word
    head = (b & 0xC0) != 0x80
    at = np.flatnonzero(head & (b >= 0xC0))
    lead, more = b[at].astype(np.int64), np.append(b, np.zeros(3, np.uint8)).astype(np.int64) & 0x3F
    two, three = (lead & 0x1F) << 6 | more[at + 1], (lead & 0x0F) << 12 | more[at + 1] << 6 | more[at + 2]
    four = (lead & 0x07) << 18 | more[at + 1] << 12 | more[at + 2] << 6 | more[at + 3]
    points, which = np.unique(np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four)), return_inverse=True)
    word[at] = np.array([p < 0x110000 and unicodedata.category(chr(p))[0] in "LMN" for p in points.tolist()], bool)[which]
    return word[np.maximum.accumulate(np.where(head, np.arange(len(b)), 0))]


def _members(b: np.ndarray, vs: np.ndarray, ve: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, start, end) of every member of the byte ranges vs..ve, which don't overlap."""
    n = len(b)
    inside = np.zeros(n + 1, np.int8)
    np.add.at(inside, vs, 1)
    np.add.at(inside, ve, -1)
    inside = np.cumsum(inside)[:n].astype(bool)
    owner = np.zeros(n, np.int64)
    owner[inside] = np.repeat(np.arange(len(vs)), ve - vs)
    word = _member_bytes(b) & inside
    edge_l = ~np.concatenate([[False], word[:-1]])
    edge_l[vs[vs < n]] = True
    edge_r = ~np.concatenate([word[1:], [False]])
    edge_r[ve[ve > vs] - 1] = True

    # Inner quotes: one after a delimiter opens, one before a delimiter closes, one that stands
    # alone does either; those within a run do nothing.
    q = np.flatnonzero((b == _SQ) & inside & (edge_l | edge_r))
    quoted_s = quoted_e = quoted_v = np.zeros(0, np.int64)
    taken = np.zeros(n, bool)
    if len(q):
        o, c, v = edge_l[q], edge_r[q], owner[q]
        first = np.concatenate([[True], v[1:] != v[:-1]])
        known = np.where(o & ~c, 1, np.where(c & ~o, 0, -1))  # -1: turns the state round
        # The state after a mark is that of the last known one, or closed at the value's start,
        # turned by the marks since.
        turns = np.cumsum(known == -1)
        base_at = np.maximum.accumulate(np.where((known >= 0) | first, np.arange(len(q)), 0))
        base = np.where(known[base_at] >= 0, known[base_at], 1)
        state = (base + turns - turns[base_at]) % 2
        before = np.where(first, 0, np.concatenate([[0], state[:-1]]))
        opens, closes = np.flatnonzero((before == 0) & (state == 1)), np.flatnonzero((before == 1) & (state == 0) & ~first)
        # An opening without a close before the value's end is no quote.
        k = np.searchsorted(closes, opens, "right")
        ok = (k < len(closes)) & (v[closes[np.minimum(k, max(len(closes) - 1, 0))]] == v[opens] if len(closes) else np.zeros(len(opens), bool))
        opens = opens[ok]
        closes = closes[k[ok]] if len(closes) else closes
        quoted_s, quoted_e, quoted_v = q[opens] + 1, q[closes], v[opens]
        mark = np.zeros(n + 1, np.int32)
        np.add.at(mark, quoted_s - 1, 1)
        np.add.at(mark, quoted_e + 1, -1)
        taken = np.cumsum(mark)[:n] > 0
        filled = np.concatenate([[0], np.cumsum(~_BLANK[b])])
        keep = filled[quoted_e] > filled[quoted_s]
        quoted_s, quoted_e, quoted_v = quoted_s[keep], quoted_e[keep], quoted_v[keep]

    free = word & ~taken
    starts = free & ~np.concatenate([[False], free[:-1]])
    starts[vs[vs < n]] |= free[vs[vs < n]]
    rs = np.flatnonzero(starts)
    # A run ends before the first byte that isn't free, at its value's end or where the next one starts.
    stop = _next_true(~free)
    re_ = np.minimum(stop[rs], ve[owner[rs]])
    plain = _next_true(b != _SQ)
    rs_ = np.minimum(plain[rs], re_)
    keep = re_ > rs_
    s = np.concatenate([rs_[keep], quoted_s])
    e = np.concatenate([re_[keep], quoted_e])
    v = np.concatenate([owner[rs[keep]], quoted_v])
    order = np.argsort(s, kind="stable")
    return v[order], s[order], e[order]


def split_members(ids: pa.Array, text: pa.Array, keys: Sequence[str]) -> pa.RecordBatch:
    """(row_id, attr_key, pos, val) of the members under `keys`."""
    text = text.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
    data = text.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    b = raw[offsets[0] : offsets[-1]]
    starts, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    schema = pa.schema([("row_id", pa.int64()), ("attr_key", pa.string()), ("pos", pa.int32()), ("val", pa.string())])
    if not len(b):
        return pa.RecordBatch.from_pylist([], schema)
    row, ks, ke, vs, ve = _pairs(b, starts, ends)
    which = np.full(len(row), -1)
    for i, k in enumerate(keys):
        which[_spelled(b, ks, ke, k.encode())] = i
    hit = np.flatnonzero((which >= 0) & (ve > vs))
    row, which, vs, ve = row[hit], which[hit], vs[hit], ve[hit]
    dq = b[np.minimum(vs, len(b) - 1)] == _DQ
    vs = vs + dq
    ve = np.maximum(ve - (dq & (b[np.maximum(ve - 1, 0)] == _DQ) & (ve > vs)), vs)
    value, s, e = _members(b, vs, ve)
    # All members of one row and key make one list, in the order of the field.
    group = row[value] * len(keys) + which[value]
    order = np.argsort(group, kind="stable")
    group, s, e = group[order], s[order], e[order]
    if not len(group):
        return pa.RecordBatch.from_pylist([], schema)
    new = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    child = np.concatenate([new, [len(group)]])
    size = (e - s).astype(np.int64)
    ends_ = np.cumsum(size)
    take = np.repeat(s - (ends_ - size), size) + np.arange(ends_[-1])
    members = pa.LargeStringArray.from_buffers(len(s), pa.py_buffer(np.concatenate([[0], ends_]).astype(np.int64).tobytes()), pa.py_buffer(b[take].tobytes()))
    lists = pa.LargeListArray.from_arrays(pa.array(child.astype(np.int64)), members)
    parent = lists.value_parent_indices().to_numpy()
    flat = lists.flatten()
    parents = group[new]
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(parents[parent] // len(keys))),
            pa.array(list(keys), pa.string()).take(pa.array(parents[parent] % len(keys))),
            pa.array((np.arange(len(flat)) - child[parent] + 1).astype(np.int32)),
            flat.cast(pa.string()),
        ],
        schema=schema,
    )


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of at most `most` bytes of text, but for single longer rows."""
    if batch.num_rows <= 1 or batch.column(1).nbytes <= most:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from _slices(batch.slice(0, half), most)
        yield from _slices(batch.slice(half), most)


def packed_members(df: DataFrame, row_id: str, packed: str, keys: Sequence[str]) -> DataFrame:
    """(row_id, attr_key, pos, val): the members under `keys` in the attribute field `packed`.

    Pairs are parted by semicolons outside double quotes; a pair is a key, blanks and a value,
    in double quotes or bare. A member is a run of letters, digits and `.` `_` `:` `-` `'`, not
    beginning with `'`, or text that stands as a whole in inner single quotes (a quote that is
    never closed is a delimiter). Letters, with what combines with them, and digits are Unicode's
    classes L, M and N; all else beyond ASCII parts members. Blank members don't
    count, repeats do; if a key comes again, pos goes on. An open double quote runs to the end
    of its field. Null and empty fields and empty tables give no rows; rows that share a row_id
    are numbered each by itself.
    """
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, SLICE_BYTES):
                yield split_members(part.column(0), part.column(1), keys)

    rows = df.where(df[packed].isNotNull()).select(df[row_id].cast("long").alias("row_id"), df[packed].alias("packed"))
    return rows.mapInArrow(run, "row_id long, attr_key string, pos int, val string")
