"""Substring deduplication with suffix arrays.

A byte goes if a 50-byte string covering it also starts in a document with a
smaller doc_id.  Sorting every suffix of a corpus across shards would move
fifty times its size, so the shards are built by content:

1. *Anchors.*  Of the k-grams inside a 50-byte window the one with the smallest
   hash is the window's anchor; it depends on the window alone, so equal windows
   have equal anchors at equal offsets.  About one position in 16 is an anchor.
2. *Whole contexts.*  All windows of an anchor lie in its context, 30 bytes before
   to 50 after its start.  Anchors are brought together by k-gram; where the whole
   context occurs in a smaller document, all its windows do.
3. *Suffix arrays.*  The other contexts of a k-gram that several documents have
   match in part.  They form shards, and each shard's text gets a suffix array by
   Larsson-Sadakane refinement and common prefixes by Kasai's rule; runs of
   common prefixes of 50 and more are equal windows, and a window goes if its run
   has a smaller document.
   A context that a document repeats takes part once; its verdict holds at all its
   places, which are kept aside as runs.  So a long run of one byte, or of a short
   period, is a few contexts.
4. *Merging.*  A k-gram with very many contexts is split over shards.  Their
   windows that are first in their own shard meet range-partitioned and sorted,
   and binary search finds the first of each in all shards.

Nothing is sampled away: every window has an anchor, and every anchor takes part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from redeemflow.llm.common import store, written

#: the anchor k-gram
GRAM = 20
#: bytes whose hashes are computed together, and bytes of one suffix array
SLAB, SHARD = 1 << 17, 1 << 20
#: documents whose anchors are found together
ROWS = 2000
#: text bytes and anchors that are worked on together
BYTES, CHUNK = 8 << 20, 1 << 20
#: contexts of one k-gram that stay in one shard
SHARD_CONTEXTS = 1024
#: one document in so many is looked at for k-grams to be dealt over several tasks; one
#: with more than a part in HEAVY_SHARE of their anchors is
LOOK, HEAVY_SHARE = 64, 100_000
#: heavy k-grams that may be broadcast
MAX_BROADCAST = 200_000

_POS_BITS = 40
_POS = (1 << _POS_BITS) - 1
_LAST = (1 << 63) - 1
#: k-gram hashes keep 48 bits: k-grams that collide only meet in vain.  Whole
#: contexts are told apart by all 64 bits of theirs, within one k-gram
_SHORT = np.uint64(16)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _M1
    x ^= x >> np.uint64(32)
    x *= _M2
    x ^= x >> np.uint64(29)
    return x


def _words(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as an integer; ``buf`` has 8 spare bytes."""
    return np.ndarray(len(buf) - 8, np.dtype("<u8"), buf.data, strides=(1,))


def _sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    n, at, size, out = len(a) - w + 1, 0, 1, None
    while True:
        if w & size:
            part = a[at:at + n]
            out = part.copy() if out is None else np.minimum(out, part)
            at += size
        if 2 * size > w:
            return out
        a = np.minimum(a[:-size], a[size:])
        size *= 2


# ------------------------------------------------------------------ anchors
def anchors(buf: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and k-gram hashes of the anchors of all ``width``-byte windows.

    ``buf`` holds documents one after another (and 8 spare bytes), ``ends`` their
    ends; no window crosses an end.
    """
    n, w = len(buf) - 8, width - GRAM + 1
    found_at, found_h = [], []
    for lo in range(0, max(n - width + 1, 0), SLAB):
        part = buf[lo:min(n, lo + SLAB + width - 1) + 8]
        v = _words(part)
        m = len(v)
        if m < width:
            continue
        h = v[:m - GRAM + 1]
        for o in (8, GRAM - 8):
            h = _mix(h) ^ v[o:o + m - GRAM + 1]
        h = (_mix(h) >> _SHORT) + np.uint64(1)  # never 0, which marks no window
        low = _sliding_min(h, w)
        # windows that cross a document's end do not count
        e = ends[(ends > lo) & (ends < lo + m)] - lo
        bad = np.zeros(len(low) + 1, np.int32)
        np.add.at(bad, np.clip(e - width + 1, 0, len(low)), 1)
        np.add.at(bad, np.clip(e, 0, len(low)), -1)
        low[np.cumsum(bad)[:-1] > 0] = 0
        none = np.zeros(w - 1, np.uint64)
        high = ~_sliding_min(~np.concatenate([none, low, none]), w)
        at = np.flatnonzero((high == h) & (high > 0))
        found_at.append(at + lo)
        found_h.append(h[at])
    if not found_at:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, h = np.concatenate(found_at), np.concatenate(found_h)
    at, first = np.unique(at, return_index=True)
    return at, h[first]


def _context_hash(buf, at, left, right, width):
    """64-bit hash of each context ``[at - left, at + right)`` and its anchor's place."""
    back = width - GRAM
    full = (left == back) & (right == width)
    c = np.zeros(len(at), np.uint64)
    v = _words(buf)
    k, a = len(v), at[full]
    x = np.zeros(len(a), np.uint64)
    offsets = [*range(-back, width - 7, 8), width - 8]
    for o in offsets:
        x = _mix(x ^ v[a + o])
    c[full] = x
    a, lf, rg = at[~full], left[~full], right[~full]
    x = _mix((lf * 4096 + rg + 1).astype(np.uint64))
    for o in range(-back, width):
        b = buf[np.clip(a + o, 0, k - 1)].astype(np.uint64) + np.uint64(1)
        x = np.where((o >= -lf) & (o < rg), _mix(x ^ b), x)
    c[~full] = x
    return c


def _first_ids(h, c, ids):
    """The smallest id of each row's (h, c)."""
    if not len(h):
        return ids
    key = _mix(h ^ _mix(c))
    order = np.argsort(key)
    k, hh, cc = key[order], h[order], c[order]
    new = np.ones(len(h), bool)
    # rows of one key that differ are told apart here and settled later
    new[1:] = (k[1:] != k[:-1]) | (hh[1:] != hh[:-1]) | (cc[1:] != cc[:-1])
    low = np.empty(len(h), np.int64)
    low[order] = np.minimum.reduceat(ids[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    return low


_ANCHOR = "kind int, h long, c long, id long, pack long"
#: kinds of rows: a context at its first place in a document, bytes to remove, more places
#: of a context.  ``pack`` holds the document's ``sub`` and a place (_POS: none); the other two
#: kinds hold a range in ``c``
_OPEN, _GONE, _ALSO = 0, 1, 2
_HALF = 31


def _range(start, end):
    return start.astype(np.int64) << _HALF | end.astype(np.int64)


def _once(at, h, c, doc, width):
    """Which contexts are the first of their kind in their document, and the other places
    of those that are repeated: arrays of (first place, run's start, run's end).  Places
    at most ``width`` apart make one run, since whatever is removed around each of them is
    at least that long."""
    keep = np.ones(len(at), bool)
    order = np.argsort(_mix(h ^ _mix(c ^ doc.astype(np.uint64) * _M1)))
    new = np.ones(len(at), bool)
    for x in (h, c, doc):
        y = x[order]
        new[1:] &= y[1:] == y[:-1]
    new[1:] = ~new[1:]
    group = np.cumsum(new) - 1
    several = (np.bincount(group, minlength=1) > 1)[group]
    rows, group = order[several], group[several]
    by = np.lexsort((at[rows], group))
    rows, group = rows[by], group[by]
    if not len(rows):
        return keep, *[np.zeros(0, np.int64)] * 4
    first = np.append(True, group[1:] != group[:-1])
    keep[rows[~first]] = False
    place = at[rows]
    begin = first | np.append(True, np.diff(place) > width)
    finish = np.append(begin[1:], True)
    rep = place[first][np.cumsum(first) - 1]
    lo, hi = place[begin], place[finish]
    more = hi > rep[begin]
    return keep, doc[rows[begin]][more], rep[begin][more], lo[more], hi[more]


def _slices(batch):
    """Parts of a batch of at most ROWS rows and BYTES bytes (a longer text is alone)."""
    size = pc.fill_null(pc.binary_length(batch.column("data")), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for k, n in enumerate(size.tolist()):
        if k > at and (held + n > BYTES or k - at == ROWS):
            yield batch.slice(at, k - at)
            at, held = k, 0
        held += n
    if len(batch) > at:
        yield batch.slice(at)


def _anchor_batches(batches, width):
    back = width - GRAM
    for b in (part for b in batches for part in _slices(b)):
        texts = b.column("data").to_pylist()
        ids = b.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
        sub = b.column("sub").to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
        buf = np.frombuffer(b"".join([*texts, bytes(8)]), np.uint8)
        starts = np.concatenate(([0], ends[:-1]))
        all_at, all_h = anchors(buf, ends, width)
        parts, also = [], []
        for k in range(0, len(all_at), CHUNK):
            at, h = all_at[k:k + CHUNK], all_h[k:k + CHUNK]
            doc = np.searchsorted(ends, at, "right")
            left, right = np.minimum(back, at - starts[doc]), np.minimum(width, ends[doc] - at)
            c = _context_hash(buf, at, left, right, width)
            keep, *more = _once(at, h, c, doc, width)
            also.append(more)
            parts.append([x[keep] for x in (at, h, c, doc, left, right)])
        if not parts:
            continue
        at, h, c, doc, left, right = (np.concatenate(x) for x in zip(*parts))
        mine = ids[doc]
        # a context seen in a smaller document of this batch is settled here; what goes
        # travels apart, neighbours as one range, and so do the other places of a context
        whole = mine > _first_ids(h, c, mine)
        ad, rep, a_lo, a_hi = (np.concatenate(x) for x in zip(*also))
        of = np.searchsorted(at, rep)
        known = whole[of]
        d, lo, hi = (np.concatenate([x[whole], y[known]]) for x, y in (
            (doc, ad), (at - left, a_lo - left[of]), (at + right, a_hi + right[of])))
        ad, rep, a_lo, a_hi = (x[~known] for x in (ad, rep, a_lo, a_hi))
        order = np.argsort(lo, kind="stable")
        d, lo, hi = d[order], lo[order], np.maximum.accumulate(hi[order])
        fresh = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (lo[1:] > hi[:-1]))[:len(d)])
        last = np.append(fresh[1:], len(d))[:len(fresh)] - 1
        d, lo, hi = d[fresh], lo[fresh] - starts[d[fresh]], hi[last] - starts[d[fresh]]
        open_ = ~whole
        pack = np.concatenate([sub[doc[open_]] << _POS_BITS | (at - starts[doc])[open_], sub[d] << _POS_BITS | _POS,
                               sub[ad] << _POS_BITS | (rep - starts[ad])])
        kind = np.repeat(np.array([_OPEN, _GONE, _ALSO], np.int32), [int(open_.sum()), len(d), len(ad)])
        who = np.concatenate([mine[open_], ids[d], ids[ad]])
        cc = np.concatenate([c[open_].view(np.int64), _range(lo, hi), _range(a_lo - starts[ad], a_hi - starts[ad])])
        spread = _mix(pack.astype(np.uint64) ^ who.astype(np.uint64) ^ _mix(cc.view(np.uint64))) >> _SHORT
        spread[:int(open_.sum())] = h[open_]
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(spread.view(np.int64)), pa.array(cc),
                                          pa.array(who), pa.array(pack)], ["kind", "h", "c", "id", "pack"])


def _meet(batches, width):
    """Anchors sorted by (h, c, id), with ``salts``: ranges to remove of those whose whole
    context is in a smaller document, and the first rows of contexts of a k-gram that has
    several contexts and several documents (or is dealt over several tasks, where that
    is taken for granted).

    Rows are held back only while their k-gram has one context or one document,
    and then only those of one document.
    """
    names = ["h", "c", "id", "pack", "salts"]
    empty = {n: np.zeros(0, np.int64) for n in names}
    held, state = empty, None  # state: h, c, smallest id of (h, c), several c, several ids
    for b in batches:
        kind = b.column("kind").to_numpy(zero_copy_only=False)
        settled = kind != _OPEN
        new = {n: b.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names}
        out = [(kind[settled], {n: new[n][settled] for n in names})]
        rows = {n: np.concatenate([held[n], new[n][~settled]]) for n in names}
        held = empty
        if len(rows["h"]):
            h, c, ids = rows["h"], rows["c"], rows["id"]
            new_h = np.ones(len(h), bool)
            new_h[1:] = h[1:] != h[:-1]
            new_c = new_h.copy()
            new_c[1:] |= c[1:] != c[:-1]
            g, k = np.cumsum(new_h) - 1, np.cumsum(new_c) - 1
            first_c = ids[new_c]
            at_h = np.flatnonzero(new_h)
            several_c = np.add.reduceat(new_c.astype(np.int64), at_h) > 1
            several_d = np.minimum.reduceat(ids, at_h) < np.maximum.reduceat(ids, at_h)
            if state and state[0] == h[0]:
                if state[1] == c[0]:
                    first_c[0] = min(first_c[0], state[2])
                else:
                    several_c[0] = True
                several_c[0] |= state[3]
                several_d[0] |= state[4] or first_c[0] != state[2]
            whole = ids > first_c[k]
            both = several_c & several_d | (rows["salts"][at_h] > 1)
            gone = {n: rows[n][whole] for n in names}
            place = gone["pack"] & _POS
            gone["c"] = _range(np.maximum(place - (width - GRAM), 0), place + width)
            out.append((np.full(len(place), _GONE, np.int32), gone))
            edge = ~whole & both[g]
            out.append((np.full(int(edge.sum()), _OPEN, np.int32), {n: rows[n][edge] for n in names}))
            state = (h[-1], c[-1], first_c[-1], several_c[-1], several_d[-1])
            if not both[-1]:
                last = ~whole & (g == g[-1])
                held = {n: rows[n][last] for n in names}
        keep = {n: np.concatenate([x[n] for _, x in out]) for n in names[:4]}
        kind = np.concatenate([k for k, _ in out])
        keep["h"][kind != _OPEN] = 0  # of no more use
        yield pa.RecordBatch.from_arrays([pa.array(kind), *(pa.array(keep[n]) for n in names[:4])], ["kind", *names[:4]])


# ------------------------------------------------------------ suffix arrays
def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks by Larsson-Sadakane refinement.

    Suffixes are sorted by their first 8 bytes; a group of equals is then sorted
    by the rank of the suffix h bytes on, h doubling, and sorted groups are left
    alone.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    keys = np.ndarray(n, np.dtype(">u8"), padded.data, strides=(1,)).astype(np.uint64)
    sa = np.argsort(keys)
    new = np.ones(n + 1, bool)
    new[1:-1] = keys[sa[1:]] != keys[sa[:-1]]
    rank = np.zeros(n + 8, np.int64)  # past the end: smaller than any
    # spare zero bytes look like zeros of the text; the ranks past the end tell them apart
    h = 8 if not n or text.min() > 0 else 1
    if h == 1:
        sa = np.argsort(text)
        new[1:-1] = text[sa[1:]] != text[sa[:-1]]
    start = np.flatnonzero(new[:-1])
    rank[sa] = np.repeat(start, np.diff(np.append(start, n))) + 1
    open_at = np.flatnonzero(~(new[:-1] & new[1:]))  # places in groups of two and more
    while len(open_at) and h < 2 * n:
        who = sa[open_at]
        group = rank[who]
        key = group.astype(np.uint64) << np.uint64(32) | rank[np.minimum(who + h, n)].astype(np.uint64)
        order = np.argsort(key)
        who, key = who[order], key[order]
        sa[open_at] = who
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(first)
        rank[who] = np.repeat(open_at[at] + 1, np.diff(np.append(at, len(key))))
        after = np.append(first[1:], True)
        open_at = open_at[~(first & after)]
        h *= 2
    return sa, rank[:n]


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``sa`` (Kasai).

    By Kasai's rule the value at text position i is at least the one at i - 1
    less one; it is exactly that where the bytes before both suffixes agree, so
    only the other positions are compared, 8 bytes at a time.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    prev = np.full(n, -1, np.int64)
    prev[sa[1:]] = sa[:-1]
    i = np.arange(n)
    apart = (prev <= 0) | (i == 0)
    apart[1:] |= text[:-1] != text[prev[1:] - 1]
    at = np.flatnonzero(apart & (prev >= 0))
    got = np.zeros(n, np.int64)
    words = _words(np.concatenate([text, np.zeros(16, np.uint8)]))
    active, far = at, np.zeros(len(at), np.int64)
    limit = n - np.maximum(at, prev[at])
    while len(active):
        x = words[np.minimum(active + far, n)] ^ words[np.minimum(prev[active] + far, n)]
        low = x & (~x + np.uint64(1))  # lowest differing bit; zero if all 8 bytes agree
        same = np.where(x == 0, 8, (np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64)) >> 3)
        far = np.minimum(far + same, limit)
        more = (x == 0) & (far < limit)
        got[active[~more]] = far[~more]
        active, far, limit = active[more], far[more], limit[more]
    last = np.maximum.accumulate(np.where(apart, i, 0))
    plcp = np.maximum(got[last] - (i - last), 0)
    return plcp[sa]


_CONTEXT = "route long, heavy boolean, id long, sub long, pos long, data binary"
_FOUND = "id long, sub long, start long, end long, pos long, w1 long, w2 long"


def _contexts(batches, width):
    """Contexts of the anchors listed with each document."""
    back = width - GRAM
    names = [f.split(" ")[0] for f in _CONTEXT.split(", ")]
    for b in batches:
        lists = [b.column(c) for c in ("pos", "route", "heavy")]
        pos, route, heavy = (x.flatten() for x in lists)
        per_doc = np.diff(lists[0].offsets.to_numpy())
        doc = np.repeat(np.arange(len(b)), per_doc)
        at = pos.to_numpy(zero_copy_only=False)
        start = np.maximum(at - back, 0)
        cuts, k = [], 0
        for data, n in zip(b.column("data"), per_doc.tolist()):
            data = data.as_py()
            cuts += [data[s:e] for s, e in zip(start[k:k + n].tolist(), (at[k:k + n] + width).tolist())]
            k += n
        yield pa.RecordBatch.from_arrays(
            [route, heavy, b.column("id").take(pa.array(doc)), b.column("sub").take(pa.array(doc)),
             pos, pa.array(cuts, pa.binary())], names)


def _shard(route_heavy, ids, sub, pos, data, width):
    """Windows of one shard: intervals to remove, and for heavy k-grams the windows
    that are the shard's first of their kind."""
    start = np.maximum(pos - (width - GRAM), 0)
    lens = np.fromiter(map(len, data), np.int64, len(data))
    # 0xFF is in no UTF-8 text: it ends a context
    text = np.frombuffer(b"\xff".join([*data, b""]), np.uint8)
    ends = np.cumsum(lens + 1) - 1
    owner = np.repeat(np.arange(len(lens)), lens + 1)
    sa, _ = suffix_array(text)
    lcp = common_prefixes(text, sa)
    room = ends[owner[sa]] - sa >= width  # a whole window starts here
    run = np.cumsum(lcp < width)
    sa, run = sa[room], run[room]
    if not len(sa):
        return _found_batch([np.zeros(0, np.int64)] * 5)
    who = owner[sa]
    first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    low = np.repeat(np.minimum.reduceat(ids[who], first), np.diff(np.append(first, len(run))))
    gone = ids[who] > low
    at = sa - (ends - lens)[who]  # within the context
    # neighbouring windows of a context make one interval
    mark = np.zeros(len(text) + 1, bool)
    mark[sa[gone]] = True
    lo = np.flatnonzero(mark[:-1] & ~np.append(False, mark[:-2]))
    hi = np.flatnonzero(mark[:-1] & ~mark[1:])
    w = owner[lo]
    shift = (start - (ends - lens))[w]
    found = [ids[w], sub[w], lo + shift, hi + shift + width, pos[w]]
    keep = ~gone & route_heavy[who]
    if not keep.any():
        return _found_batch(found)
    windows = text[sa[keep][:, None] + np.arange(width)].astype(np.uint64)
    w1 = w2 = np.zeros(len(windows), np.uint64)
    for k in range(width):
        w1, w2 = _mix(w1 ^ windows[:, k] + np.uint64(k + 1)), _mix(w2 + windows[:, k] * _M1 + np.uint64(7))
    w = who[keep]
    more = [ids[w], sub[w], at[keep] + start[w], at[keep] + start[w] + width, pos[w]]
    return _found_batch([np.concatenate(x) for x in zip(found, more)], len(found[0]), w1.view(np.int64), w2.view(np.int64))


def _found_batch(cols, plain=None, w1=None, w2=None):
    """A batch of found rows; the first ``plain`` rows (all by default) have no window key."""
    n = len(cols[0])
    keys = []
    for w in (w1, w2):
        if w is None:
            keys.append(pa.nulls(n, pa.int64()))
        else:
            keys.append(pa.concat_arrays([pa.nulls(plain, pa.int64()), pa.array(w)]))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), *keys],
                                      [f.split(" ")[0] for f in _FOUND.split(", ")])


def _shards(batches, width):
    """Contexts sorted by route, cut into shards at route borders."""
    held: list[pa.RecordBatch] = []
    size = 0

    def run(parts):
        cols = [np.concatenate([p.column(k).to_numpy(zero_copy_only=False) for p in parts]) for k in range(1, 5)]
        data = [x for p in parts for x in p.column(5).to_pylist()]
        return _shard(cols[0].astype(bool), *(c.astype(np.int64) for c in cols[1:]), data, width)

    for b in batches:
        route = b.column(0).to_numpy(zero_copy_only=False)
        borders = np.flatnonzero(np.append(True, route[1:] != route[:-1]))
        if held and len(route) and held[-1].column(0)[len(held[-1]) - 1].as_py() == route[0]:
            borders = borders[1:]
        offsets = np.frombuffer(b.column(5).buffers()[1], np.int32)[b.column(5).offset:][:len(b) + 1]
        done = 0
        for cut_at in borders.tolist():
            size_here = size + int(offsets[cut_at] - offsets[done]) + cut_at - done
            if size_here >= SHARD:
                yield run([*held, b.slice(done, cut_at - done)])
                held, size, done = [], 0, cut_at
        if len(b) > done:
            held.append(b.slice(done))
            size += int(offsets[len(b)] - offsets[done]) + len(b) - done
    if held:
        yield run(held)


def _merge(batches):
    """Windows of all shards sorted by (w1, w2, id): those after a smaller id."""
    last = None
    for b in batches:
        cols = [b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(7)]
        ids, w1, w2 = cols[0], cols[5], cols[6]
        if not len(ids):
            continue
        first = np.searchsorted(w1, w1, "left")  # binary search for a window's first shard
        low = ids[first]
        mixed = w2[first] != w2
        if mixed.any():  # two windows of equal w1
            new = np.append(True, (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]))
            low = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
        if last is not None:
            same = (w1 == last[0]) & (w2 == last[1])
            low = np.where(same, np.minimum(low, last[2]), low)
        last = (w1[-1], w2[-1], low[-1])
        gone = ids > low
        yield pa.RecordBatch.from_arrays([pa.array(c[gone]) for c in cols],
                                         [f.split(" ")[0] for f in _FOUND.split(", ")])


# ---------------------------------------------------------------- operator
def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with ``id`` (a null doc_id comes after every other), ``sub`` (part of the
    text's hash: keeps rows of one id with different texts apart) and bytes."""
    return docs.select(
        F.struct("*").alias("_row"), "doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("_id"),
        F.xxhash64("text").bitwiseAND(F.lit(0x3FFFFF)).alias("_sub"))


def _dealt(data: DataFrame, width: int) -> DataFrame:
    """``h, salts``: k-grams that so many documents have that their contexts are dealt over
    ``salts`` tasks.  Which those are decides about tasks alone, not about results, so they
    are told from the anchors of one document in LOOK; at most HEAVY_SHARE rows."""
    few = data.where(F.pmod(F.xxhash64("id", "sub"), F.lit(LOOK)) == 0)
    seen = few.mapInArrow(lambda it: _anchor_batches(it, width), _ANCHOR).where(F.col("kind") == _OPEN)
    counts = written(seen.groupBy("h").count().where("count > 1"), "seen")
    part = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0] // HEAVY_SHARE + 16
    return counts.where(F.col("count") > part).select("h", F.ceil(F.col("count") / part).alias("salts"))


def removed_ranges(docs: DataFrame, width: int = 50) -> DataFrame:
    """``id, sub, ranges`` per document: ``ranges`` are arrays ``starts, ends, pos, also`` (for
    ``spread_ranges``): byte ranges, overlapping and unclipped, to remove, found at the place
    ``pos`` (-1: at no place that stands for others), and where ``also`` is set, further places
    (a run from start to end) of the context at ``pos``."""
    if width < GRAM + 8:
        raise ValueError(f"windows have at least {GRAM + 8} bytes")
    data = _keyed(docs).select(F.col("_id").alias("id"), F.col("_sub").alias("sub"),
                               F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))
    met = (data.mapInArrow(lambda it: _anchor_batches(it, width), _ANCHOR)
           .join(F.broadcast(_dealt(data, width)), "h", "left").withColumn("salts", F.coalesce("salts", F.lit(1))))
    found = store(met.repartition("h", F.pmod("c", "salts")).sortWithinPartitions("h", "c", "id")
                  .mapInArrow(lambda it: _meet(it, width), _ANCHOR), "anchors")
    pos, sub = F.col("pack").bitwiseAND(F.lit(_POS)), F.shiftright("pack", _POS_BITS)
    settled = found.where(F.col("kind") != _OPEN).select(
        "id", sub.alias("sub"), F.shiftright("c", _HALF).alias("start"),
        F.col("c").bitwiseAND(F.lit((1 << _HALF) - 1)).alias("end"),
        F.when(pos == _POS, F.lit(-1)).otherwise(pos).alias("pos"), (F.col("kind") == _ALSO).alias("also"))
    part = found.where(F.col("kind") == _OPEN)
    heavy = store(part.groupBy("h").count().where(F.col("count") > SHARD_CONTEXTS)
                  .select("h", F.ceil(F.col("count") / SHARD_CONTEXTS).alias("salts")), "heavy")
    if heavy.count() <= MAX_BROADCAST:
        heavy = F.broadcast(heavy)
    salts = F.coalesce("salts", F.lit(1))
    windows = store(_windows(data, part.join(heavy, "h", "left").select(
        "id", sub.alias("sub"), pos.alias("pos"), (salts > 1).alias("heavy"),
        F.xxhash64("h", F.pmod("c", salts)).alias("route")), width), "windows")
    merged = (windows.where("w1 is not null").repartitionByRange("w1", "w2")
              .sortWithinPartitions("w1", "w2", "id").mapInArrow(_merge, _FOUND))
    plain = [*(F.col(c) for c in ("id", "sub", "start", "end", "pos")), F.lit(False).alias("also")]
    spans = settled.unionByName(windows.where("w1 is null").select(*plain)).unionByName(merged.select(*plain))
    return (spans.groupBy("id", "sub").agg(F.collect_list(F.struct("start", "end", "pos", "also")).alias("x"))
            .select("id", "sub", F.struct(F.col("x.start").alias("starts"), F.col("x.end").alias("ends"),
                                          F.col("x.pos").alias("pos"), F.col("x.also").alias("also")).alias("ranges")))


def spread_ranges(starts, ends, pos, also):
    """The ranges of a document, those found at one place of a context repeated at its
    other places."""
    if not also.any():
        return starts, ends
    order = np.argsort(pos[also], kind="stable")
    rep, lo, hi = pos[also][order], starts[also][order], ends[also][order]
    s, e, p = starts[~also], ends[~also], pos[~also]
    a, b = np.searchsorted(rep, p, "left"), np.searchsorted(rep, p, "right")
    n = np.where(p >= 0, b - a, 0)
    which = np.repeat(np.arange(len(p)), n)
    run = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
    return (np.concatenate([s, lo[run] + s[which] - p[which]]), np.concatenate([e, hi[run] + e[which] - p[which]]))


def _windows(data: DataFrame, part: DataFrame, width: int) -> DataFrame:
    """What the shards find in the contexts of the anchors ``part``."""
    listed = (part.groupBy("id", "sub").agg(F.collect_list(F.struct("pos", "route", "heavy")).alias("x"))
              .select("id", "sub", "x.pos", "x.route", "x.heavy"))
    return (data.join(listed, ["id", "sub"]).select("data", "id", "sub", "pos", "route", "heavy")
            .mapInArrow(lambda it: _contexts(it, width), _CONTEXT)
            .repartition("route").sortWithinPartitions("route")
            .mapInArrow(lambda it: _shards(it, width), _FOUND))


def kept_parts(n: int, starts: np.ndarray, ends: np.ndarray) -> tuple[list[tuple[int, int]], int, int]:
    """What is left of ``n`` bytes, how many bytes go, and in how many runs."""
    s, e = np.maximum(starts, 0), np.minimum(ends, n)
    s, e = s[e > s], e[e > s]
    if not len(s):
        return [(0, n)] if n else [], 0, 0
    order = np.argsort(s)
    s, e = s[order], np.maximum.accumulate(e[order])
    first = np.append(True, s[1:] > e[:-1])
    lo, hi = s[first], e[np.append(np.flatnonzero(first)[1:] - 1, len(e) - 1)]
    gaps = zip(np.append(0, hi).tolist(), np.append(lo, n).tolist())
    return [(a, b) for a, b in gaps if b > a], int((hi - lo).sum()), len(lo)


def _with_ranges(docs: DataFrame, width: int) -> DataFrame:
    ranges = removed_ranges(docs, width).select(F.col("id").alias("_id"), F.col("sub").alias("_sub"), "ranges")
    return _keyed(docs).join(ranges, ["_id", "_sub"], "left")


def _kept(b: pa.RecordBatch, texts: pa.Array):
    """Bytes, and ``kept_parts``, of each row of a batch."""
    types = {"starts": np.int64, "ends": np.int64, "pos": np.int64, "also": bool}
    for data, r in zip(texts.cast(pa.binary()), b.column("ranges")):
        data = data.as_py() or b""
        if not r.is_valid:
            yield data, *kept_parts(len(data), np.zeros(0, np.int64), np.zeros(0, np.int64))
            continue
        found = [np.asarray(r[c].values.to_numpy(zero_copy_only=False), t) for c, t in types.items()]
        yield data, *kept_parts(len(data), *spread_ranges(*found))


_REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _report(batches):
    for b in batches:
        out = [(len(data), removed, runs, hashlib.sha256(b"".join([data[s:e] for s, e in kept])).hexdigest())
               for data, kept, removed, runs in _kept(b, b.column("text"))]
        cols = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
            [f.split(" ")[0] for f in _REPORT.split(", ")])


def _clean(batches):
    for b in batches:
        texts = b.column("_row").field("text")
        left = [b"".join([data[s:e] for s, e in kept]).decode("utf-8", "ignore") if removed else None
                for data, kept, removed, _ in _kept(b, texts)]
        yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(left, pa.string())], ["_row", "_left"])


def report(docs: DataFrame, width: int = 50) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Defined cases: a null or empty text has no bytes and loses none; texts
    shorter than ``width`` lose none; a null doc_id counts as larger than every
    other; rows of equal doc_id do not remove each other, and repeated rows get
    the same result (rows of one doc_id with other texts are told apart by 22 bits of the
    texts' hash: where those agree, both lose what either loses); other columns are ignored.
    """
    rows = _with_ranges(docs, width).select(F.col("doc_id").cast("long"), "text", "ranges")
    return rows.mapInArrow(_report, _REPORT)


def cleaned(docs: DataFrame, width: int = 50) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text`` (a character cut in two
    goes as a whole); rows of which nothing is left go, unless they were empty."""
    rows = _with_ranges(docs, width).select("_row", "ranges")
    schema = StructType([rows.schema["_row"], StructField("_left", StringType())])
    # `_left` is null where nothing goes
    rows = rows.mapInArrow(_clean, schema).where("_left is null or _left <> ''")
    text = F.coalesce("_left", F.col("_row.text"))
    return rows.select(F.col("_row").withField("text", text).alias("_row")).select("_row.*")
