"""Suffix-array deduplication of repeated byte strings.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier is
found, exactly, in four steps that each deal their data over all tasks:

1. Every window of ``LENGTH`` bytes has an anchor, the smallest hash among its
   runs of ``GRAM`` bytes, the leftmost of equal ones.  It depends on the
   window's bytes only, so equal windows have equal anchors.  Tasks look for
   anchors that occur again; windows of others can't repeat.
2. The text around repeated anchors, a piece each, is cut out of the documents
   and dealt into shards by anchor.  Equal pieces are merged by comparing their
   bytes: the first stays, the others go as a whole, so exact copies never reach
   a suffix array more than once.  Pieces of an anchor that occurs more than
   ``HOT`` times are dealt by their own bytes instead, the first of a task's
   equal ones only; what is left of them are the anchor's distinct pieces, and
   those are dealt into shards of ``SHARD`` pieces, whatever the number of tasks.
3. A shard sorts its suffixes by Larsson-Sadakane refinement, takes common
   prefixes by Kasai's scan, and so has the classes of equal windows and the
   first of each; the others are removed.
4. An anchor with more than one shard has its classes merged across them: each
   shard's sorted windows are looked up in those before by binary search.

Nothing is capped: hashes decide where bytes are compared, never whether they are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toneflow.llm.tables import stored

LENGTH, GRAM = 100, 32
WINDOWS = LENGTH - GRAM + 1
#: Occurrences of an anchor beyond which it is hot; occurrences a batch sends to find repeats.
HOT, SEND = 2048, 64
#: Distinct pieces of a hot anchor that are compared in one shard; bytes of pieces that a task gathers before it deals them.
SHARD, GATHER = 4096, 1 << 22
#: Bytes of text that are hashed at a time, and that make a suffix array.
PIECE, CHUNK = 1 << 21, 1 << 20
POSITION = np.uint64(0xFFFFFF)


def pack(*arrays: np.ndarray) -> bytes:
    heads = [np.array([len(a), np.dtype(a.dtype).num], "<i8").tobytes() for a in arrays]
    return b"".join(x for h, a in zip(heads, arrays, strict=True) for x in (h, a.tobytes()))


TYPES = {np.dtype(t).num: np.dtype(t) for t in ("u1", "i4", "i8", "u8")}


def unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n, kind = np.frombuffer(data, "<i8", 2, at)
        out.append(np.frombuffer(data, TYPES[int(kind)], int(n), at + 16))
        at += 16 + out[-1].nbytes
    return out


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from every position on."""
    h, m, n = data.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    while n < GRAM:
        h = h[:-n] * np.uint64(m) + (h[n:] ^ (h[n:] >> np.uint64(29)))
        m, n = (m * m + 2) & (1 << 64) - 1, 2 * n
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(data: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same anchor: (first window, windows, hash, place of the anchor).

    ``windows`` tells for every position whether a window may start there.
    """
    if len(data) < LENGTH:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64), none
    hashes = gram_hashes(data)
    low = (hashes & ~POSITION) | np.arange(len(hashes), dtype=np.uint64)
    n = 1
    while 2 * n <= WINDOWS:
        low = np.minimum(low[:-n], low[n:])
        n *= 2
    low = np.minimum(low[:len(hashes) - WINDOWS + 1], low[WINDOWS - n:])
    starts = np.flatnonzero(windows[:len(low)])
    if not len(starts):
        return starts, starts, np.empty(0, np.uint64), starts
    low = low[starts]
    new = np.concatenate(([True], (low[1:] != low[:-1]) | (np.diff(starts) != 1)))
    at = np.flatnonzero(new)
    place = (low[at] & POSITION).astype(np.int64)
    return starts[at], np.diff(np.concatenate((at, [len(low)]))), hashes[place], place


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts side by side, about ``PIECE`` bytes at a time: (bytes, windows, text of each part, (place, offset) of each part).

    A longer text comes in parts that overlap, so that every window is whole in one.
    """
    parts, size = [], 0
    for i, t in enumerate(texts):
        for off in range(0, max(1, len(t) - LENGTH + 1), PIECE):
            part = t[off:off + PIECE + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            parts.append((i, off, part))
            size += len(part)
            if size >= PIECE:
                yield _side_by_side(parts)
                parts, size = [], 0
    if parts:
        yield _side_by_side(parts)


def _side_by_side(parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    sizes = np.array([len(p[2]) for p in parts])
    ends = np.cumsum(sizes)
    windows = np.ones(len(data), bool)
    for e in ends:
        windows[e - LENGTH + 1:e] = False
    return data, windows, np.array([p[0] for p in parts]), np.column_stack((ends - sizes, [p[1] for p in parts]))


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes at least.

    Larsson-Sadakane refinement: suffixes with equal first h bytes form a group,
    named by its last place; groups that aren't settled are sorted by the group
    of the suffix h bytes on, and h doubles.
    """
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k:n + k]
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    last = np.concatenate((ordered[1:] != ordered[:-1], [True]))
    ends = np.flatnonzero(last)
    rank = np.empty(n, np.int64)
    sizes = np.diff(np.concatenate(([-1], ends)))
    rank[sa] = np.repeat(ends, sizes)
    h = 8
    open_ = np.repeat(sizes > 1, sizes)
    while h < depth and open_.any():
        at = np.flatnonzero(open_)
        who = sa[at]
        ahead = who + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        group = rank[who]
        # Groups lie one after the other, so one sort by (group, second) sorts each of them.
        both = group * (n + 1) + second
        order = np.argsort(both, kind="stable")
        sa[at] = who[order]
        both = both[order]
        cut = np.concatenate((both[1:] != both[:-1], [True]))
        parts = np.diff(np.concatenate(([-1], np.flatnonzero(cut))))
        rank[sa[at]] = np.repeat(at[np.flatnonzero(cut)], parts)
        open_[at] = np.repeat(parts > 1, parts)
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, sa: np.ndarray, starts: np.ndarray, sizes: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of every suffix with the one before it in ``sa``, up to ``limit``.

    Kasai's scan, run over all texts side by side: from one position to the next
    a common prefix loses one byte at most, so it is compared from there on, eight
    bytes at a time.  Suffixes that agree in all of ``sa``'s depth may be in any
    order; after those, the scan goes on only if their neighbours move along.
    """
    n = len(data)
    padded = np.concatenate((data, np.zeros(limit + 16, np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, np.int64)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    known, beside = np.zeros(len(starts), np.int64), np.full(len(starts), -2)
    for off in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -off, side="left"))  # texts that are longer than off
        i = starts[:live] + off
        j = before[i]
        length = np.maximum(known[:live] - 1, 0)
        length[(known[:live] >= limit) & (j != beside[:live] + 1)] = 0
        todo = np.flatnonzero((j >= 0) & (length < limit))
        length[j < 0] = 0
        while len(todo):
            a, b = i[todo] + length[todo], j[todo] + length[todo]
            inside = (a < n) & (b < n)
            todo, a, b = todo[inside], a[inside], b[inside]
            same = words[a] == words[b]
            whole = same.all(axis=1)
            length[todo] += np.where(whole, 8, np.argmin(same, axis=1))
            todo = todo[whole & (length[todo] < limit)]
        length = np.minimum(length, limit)
        out[i] = length
        known[:live], beside[:live] = length, j
    return out[sa]


def window_classes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Class of the window at every position of the texts side by side, and whether one starts there.

    Windows with equal bytes have equal classes.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes) - sizes
    sa = suffix_array(data, LENGTH)
    prefixes = common_prefixes(data, sa, starts, sizes, LENGTH)
    classes = np.empty(len(data), np.int64)
    classes[sa] = np.cumsum(prefixes < LENGTH)
    offset = np.arange(len(data)) - np.repeat(starts, sizes)
    return classes, offset + LENGTH <= np.repeat(sizes, sizes)


def _anchor_batches(parts: int):
    """Tasks of step 1: per part of the anchors, (hash, row, place) and whether an anchor is hot in this batch."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(k, 2000) for whole in batches for k in range(0, len(whole), 2000)):
            rows = b.column(0).to_numpy(zero_copy_only=False)
            texts = [(t.as_py() or "").encode("utf-8", "replace") for t in b.column(1)]
            h, r, v = [], [], []
            for data, windows, who, place in pieces(texts):
                first, n, hashes, at = anchors(data, windows)
                part = np.searchsorted(place[:, 0], first, side="right") - 1
                h.append(hashes)
                r.append(rows[who[part]])
                v.append((first - place[part, 0] + place[part, 1]) << 16 | n << 8 | (at - first))
            if not h:
                continue
            h, r, v = map(np.concatenate, (h, r, v))
            _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
            hot = counts[inverse] > SEND
            # Of a hot anchor, two occurrences tell that it is hot; the others needn't be looked at again.
            order = np.argsort(inverse, kind="stable")
            nth = np.empty(len(h), np.int64)
            nth[order] = np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)
            to = (h >> np.uint64(40)).astype(np.int64) % parts
            away = hot & (nth >= 2)
            to[away] = (r[away] & 0x7FFFFFFF) % parts
            kind = hot.astype(np.uint8) + away
            order = np.argsort(to, kind="stable")
            cuts = np.flatnonzero(np.diff(to[order])) + 1
            groups = np.split(order, cuts)
            yield pa.RecordBatch.from_arrays([
                pa.array([int(to[g[0]]) for g in groups], pa.int32()),
                pa.array([pack(h[g], r[g], v[g], kind[g]) for g in groups], pa.binary())], ["part", "data"])

    return of


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks of step 1: the anchors of a part that occur again, by row."""
    blobs = [unpack(x.as_py()) for b in batches for x in b.column(0)]
    if not blobs:
        return
    h, r, v, kind = (np.concatenate([x[k] for x in blobs]) for k in range(4))
    away = kind == 2
    _, inverse, counts = np.unique(h[~away], return_inverse=True, return_counts=True)
    hot = (counts > HOT) | (np.bincount(inverse, kind[~away], len(counts)) > 0)
    again = (counts[inverse] > 1) | hot[inverse]
    h = np.concatenate((h[~away][again], h[away]))
    r = np.concatenate((r[~away][again], r[away]))
    v = np.concatenate((v[~away][again], v[away]))
    spread = np.concatenate((hot[inverse][again], np.ones(int(away.sum()), bool)))
    for k in range(0, len(h), 1 << 16):
        s = slice(k, k + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(r[s]), pa.array(h[s].view(np.int64)), pa.array(v[s]), pa.array(spread[s])],
                                         ["row", "hash", "place", "hot"])


Key = tuple[int, bool, bytes]


def _first_places(piece: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the (doc, row, place) of all pieces those that are first in their piece, with it, and the others, with it.

    Rows that repeat an id and a place have no earlier one among themselves; what is listed twice counts once.
    """
    order = np.lexsort((at[:, 1], at[:, 2], at[:, 0], piece))
    piece, at = piece[order], at[order]
    new = np.ones(len(piece), bool)
    new[1:] = piece[1:] != piece[:-1]
    fresh = new.copy()
    fresh[1:] |= (at[1:] != at[:-1]).any(axis=1)
    lead = np.maximum.accumulate(np.where(new, np.arange(len(piece)), 0))
    first = (at[:, 0] == at[lead, 0]) & (at[:, 2] == at[lead, 2])
    later = fresh & ~first
    first &= fresh
    return piece[first], at[first], piece[later], at[later]


def _cut(parts: int):
    """Tasks of step 2: the pieces around repeated anchors, by shard, and hot pieces that go already."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[Key, list[tuple[int, int, int]]] = {}
        seen: set[int] = set()
        size = 0
        for whole in batches:
            for k in range(0, len(whole), 500):
                size += gather(whole.slice(k, 500), found, seen)
                if size >= GATHER:
                    yield deal(found)
                    found, size = {}, 0
        if found:
            yield deal(found)

    def gather(b: pa.RecordBatch, found: dict, seen: set[int]) -> int:
        size = 0
        ids, rows = b.column(0).to_pylist(), b.column(1).to_pylist()
        lists = b.column(3)
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        flat = lists.flatten()
        hashes, places, hots = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        for i, (doc, row) in enumerate(zip(ids, rows, strict=True)):
            if row in seen:  # a repeated row keeps the same bytes
                continue
            seen.add(row)
            text = b.column(2)[i].as_py().encode("utf-8", "replace")
            s = slice(offsets[i], offsets[i + 1])
            first, n = places[s] >> 16, places[s] >> 8 & 0xFF
            good = first + n + LENGTH - 1 <= len(text)
            for f, m, h, hot, ok in zip(first.tolist(), n.tolist(), hashes[s].tolist(), hots[s].tolist(), good.tolist(), strict=True):
                # A row key that two rows share brings places that don't fit; they do no harm.
                if ok:
                    key = h, hot, text[f:f + m + LENGTH - 1]
                    at = found.setdefault(key, [])
                    size += 0 if at else len(key[2])
                    at.append((doc, row, f))
        return size

    def deal(found: dict[Key, list[tuple[int, int, int]]]) -> pa.RecordBatch:
        keys = list(found)
        sizes = np.array([len(k[2]) for k in keys], np.int64)
        times = np.fromiter(map(len, found.values()), np.int64, len(keys))
        at = np.array([p for places in found.values() for p in places], np.int64).reshape(-1, 3)
        # Of equal pieces the first ones go on; the others are not first anywhere.
        piece, at, gone_piece, gone = _first_places(np.repeat(np.arange(len(keys)), times), at)
        upto = np.searchsorted(piece, np.arange(len(keys) + 1))
        to = np.array([(xxhash.xxh32_intdigest(k[2]) if k[1] else k[0] >> 33) % parts for k in keys])
        away = gone[:, 1] % parts
        out = []
        for part in np.unique(np.concatenate((to, away))).tolist():
            g, leave = np.flatnonzero(to == part), away == part
            mine = [keys[j] for j in g.tolist()]
            here = np.concatenate([at[upto[j]:upto[j + 1]] for j in g.tolist()]) if len(g) else at[:0]
            out.append((part, pack(
                np.array([k[0] for k in mine], np.int64), np.array([k[1] for k in mine], np.uint8), sizes[g].astype(np.int32),
                np.diff(upto)[g].astype(np.int32), np.frombuffer(b"".join(k[2] for k in mine), np.uint8),
                *(here[:, c].copy() for c in range(3)), *(gone[leave, c] for c in range(3)), sizes[gone_piece[leave]])))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())],
                                          ["part", "data"])

    return of


def _runs(flags: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of set flags that don't cross a start: (first, length)."""
    edge = np.zeros(len(flags) + 1, bool)
    edge[starts] = True
    f = np.concatenate((flags, [False]))
    begin = f & (edge | np.concatenate(([True], ~f[:-1])))
    stop = f & np.concatenate((~f[1:] | edge[1:], [True]))
    first = np.flatnonzero(begin)
    return first, np.flatnonzero(stop) - first + 1


SPANS = "row long, id long, start long, size long, hash long, text binary"


def _span_batch(row, doc, start, size, hash_=None, text=None) -> pa.RecordBatch:
    hash_ = pa.nulls(len(row), pa.int64()) if hash_ is None else pa.array(hash_, pa.int64())
    text = pa.nulls(len(row), pa.binary()) if text is None else pa.array(text, pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(doc, pa.int64()), pa.array(start, pa.int64()),
                                       pa.array(size, pa.int64()), hash_, text], ["row", "id", "start", "size", "hash", "text"])


def _spans_of(at: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(at), 1 << 16):
        s = slice(k, k + (1 << 16))
        yield _span_batch(at[s, 1], at[s, 0], at[s, 2], size[s])


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks of steps 2 and 3: spans that a shard removes, and the distinct pieces of hot anchors at their first places."""
    number: dict[Key, int] = {}
    none = np.empty((0, 3), np.int64)
    piece, at, rest, rest_sizes = [none[:, 0]], [none], [none], [none[:, 0]]
    for b in batches:
        for x in b.column(0):
            h, hot, sizes, times, data, doc, row, first, *gone, gone_sizes = unpack(x.as_py())
            rest.append(np.column_stack(gone))
            rest_sizes.append(gone_sizes)
            ends, data = np.cumsum(sizes).tolist(), data.tobytes()
            who = [number.setdefault((hash_, bool(s), data[e - n:e]), len(number))
                   for hash_, s, e, n in zip(h.tolist(), hot.tolist(), ends, sizes.tolist(), strict=True)]
            piece.append(np.repeat(np.array(who, np.int64), times))
            at.append(np.column_stack((doc, row, first)))
    keys = sorted(number)
    rank = np.empty(len(keys), np.int64)
    rank[[number[k] for k in keys]] = np.arange(len(keys))
    sizes = np.array([len(k[2]) for k in keys], np.int64)
    piece, at, later, gone = _first_places(rank[np.concatenate(piece)], np.concatenate(at))
    yield from _spans_of(np.concatenate((*rest, gone)), np.concatenate((*rest_sizes, sizes[later])))
    del number, rest, rest_sizes, later, gone
    hot = np.flatnonzero(np.array([k[1] for k in keys], bool)[piece])
    for i in range(0, len(hot), 1 << 14):
        some = hot[i:i + (1 << 14)]
        mine, place = [keys[p] for p in piece[some].tolist()], at[some]
        yield _span_batch(place[:, 1], place[:, 0], place[:, 2], sizes[piece[some]], [k[0] for k in mine], [k[2] for k in mine])
    # Cold anchors lie in one shard each, which has all there is to compare.
    upto = np.searchsorted(piece, np.arange(len(keys) + 1)).tolist()
    yield from _chunks((k, at[upto[i]:upto[i + 1]]) for i, k in enumerate(keys) if not k[1])


def _chunks(pieces_: Iterator[tuple[Key, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Compare the pieces of anchors, which come together, about ``CHUNK`` bytes at a time."""
    firsts: dict[Key, np.ndarray] = {}
    size, last = 0, None
    for key, places in pieces_:
        if size >= CHUNK and key[0] != last:
            yield from _compare(firsts)
            firsts, size = {}, 0
        firsts[key] = places
        size, last = size + len(key[2]), key[0]
    if firsts:
        yield from _compare(firsts)


def _hot_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks of step 3 for the distinct pieces of hot anchors; rows come sorted by anchor and shard.

    A shard of an anchor with several is compared on its own, whatever else the task has.
    """
    def shards() -> Iterator[tuple[bool, dict[Key, np.ndarray]]]:
        now, held = None, {}
        for b in batches:
            columns = (b.column(c).to_pylist() for c in ("hash", "shard", "shards", "text", "id", "row", "start"))
            for h, shard, n, text, doc, row, start in zip(*columns, strict=True):
                if (h, shard) != now and held:
                    yield next(iter(held))[1], held
                    held = {}
                now, key, place = (h, shard), (h, n > 1, text), np.array([[doc, row, start]], np.int64)
                held[key] = np.concatenate((held[key], place)) if key in held else place
        if held:
            yield next(iter(held))[1], held

    whole: list[dict[Key, np.ndarray]] = []
    for several, firsts in shards():
        if several:
            yield from _compare(firsts)
        else:
            whole.append(firsts)
            if sum(map(len, whole)) >= SHARD:
                yield from _chunks(x for w in whole for x in w.items())
                whole = []
    yield from _chunks(x for w in whole for x in w.items())


def _compare(firsts: dict[Key, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Spans that differing pieces of the same anchors remove from each other.

    Pieces marked in their key have their first windows handed on, which other shards may have too.
    """
    keys = list(firsts)
    _, inverse, counts = np.unique(np.array([k[0] for k in keys], np.int64), return_inverse=True, return_counts=True)
    keys = [k for k, n in zip(keys, counts[inverse].tolist(), strict=True) if n > 1 or k[1]]
    if not keys:
        return
    texts = [k[2] for k in keys]
    classes, starts_here = window_classes(texts)
    sizes = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    begin = np.cumsum(sizes) - sizes
    offset = np.arange(len(classes)) - begin[owner]
    places = [firsts[k] for k in keys]
    head = np.array([p[0] for p in places])
    at = np.flatnonzero(starts_here)
    doc, pos = head[owner[at], 0], head[owner[at], 2] + offset[at]
    order = np.lexsort((pos, doc, classes[at]))
    c = classes[at][order]
    new = np.concatenate(([True], c[1:] != c[:-1]))
    lead = np.repeat(np.flatnonzero(new), np.diff(np.concatenate((np.flatnonzero(new), [len(c)]))))
    later = (doc[order] != doc[order][lead]) | (pos[order] != pos[order][lead])
    flags = np.zeros(len(classes), bool)
    flags[at[order[later]]] = True
    first, length = _runs(flags, begin)
    who = owner[first]
    out = [(p[1], p[0], p[2] + o, n + LENGTH - 1) for w, o, n in zip(who.tolist(), offset[first].tolist(), length.tolist(), strict=True)
           for p in places[w].tolist()]
    if out:
        yield _span_batch(*zip(*out, strict=True))
    # The first windows of marked pieces, in the order of the suffix array's classes.
    marked = np.array([k[1] for k in keys], bool)
    kept = at[order[~later & marked[owner[at[order]]]]]
    for k in range(0, len(kept), 1 << 14):
        part = kept[k:k + (1 << 14)]
        rows = [(p[1], p[0], p[2] + int(offset[i]), texts[owner[i]][int(offset[i]):int(offset[i]) + LENGTH])
                for i in part.tolist() for p in places[owner[i]].tolist()]
        row, doc_, start, window = zip(*rows, strict=True)
        yield _span_batch(row, doc_, start, [LENGTH] * len(rows), None, window)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks of step 4: of the first windows of all shards, those that have an earlier equal one.

    Runs of sorted windows are looked up in what came before by binary search.
    A sentinel byte keeps windows that end in NUL bytes apart.
    """
    known = np.empty(0, f"S{LENGTH + 1}")
    doc_of = pos_of = row_of = np.empty(0, np.int64)
    for b in batches:
        if not len(b):
            continue
        row, doc, start = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        window = np.array([w + b"\x01" for w in b.column(5).to_pylist()], f"S{LENGTH + 1}")
        order = np.lexsort((row, start, doc, window))
        window, doc, start, row = window[order], doc[order], start[order], row[order]
        new = np.concatenate(([True], window[1:] != window[:-1]))
        lead = np.repeat(np.flatnonzero(new), np.diff(np.concatenate((np.flatnonzero(new), [len(window)]))))
        later = (doc != doc[lead]) | (start != start[lead])
        at = np.searchsorted(known, window)
        hit = np.zeros(len(window), bool)
        inside = at < len(known)
        hit[inside] = known[at[inside]] == window[inside]
        prior = np.where(hit, at, 0)
        if hit.any():
            before = (doc_of[prior] < doc) | ((doc_of[prior] == doc) & (pos_of[prior] < start))
            later |= hit & before
            # A known window that this run precedes is removed in its stead.
            earlier = hit & new & ((doc < doc_of[prior]) | ((doc == doc_of[prior]) & (start < pos_of[prior])))
            if earlier.any():
                p = prior[earlier]
                yield _span_batch(row_of[p], doc_of[p], pos_of[p], np.full(len(p), LENGTH))
                doc_of[p], pos_of[p], row_of[p] = doc[earlier], start[earlier], row[earlier]
        if later.any():
            yield _span_batch(row[later], doc[later], start[later], np.full(int(later.sum()), LENGTH))
        fresh = new & ~hit
        known = np.concatenate((known, window[fresh]))
        order = np.argsort(known, kind="stable")
        known = known[order]
        doc_of = np.concatenate((doc_of, doc[fresh]))[order]
        pos_of = np.concatenate((pos_of, start[fresh]))[order]
        row_of = np.concatenate((row_of, row[fresh]))[order]


def _rows(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id long, row, text): ids order the documents, nulls last; a row is named by id and text."""
    id_ = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    return docs.select(id_.alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), F.col(text_col).alias("text"),
                       *more)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, spans): for every row with some, the spans (start, size) of bytes that a string of ``LENGTH`` bytes
    which starts earlier covers; spans may overlap.

    Earlier is a smaller id, or an earlier place in the same one.  Rows that
    share an id are one document to this end: they are compared by place.  Rows
    equal in id and text keep the same bytes.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _rows(docs, id_col, text_col)
    found = rows.filter(F.octet_length("text") >= LENGTH)
    blobs = found.select("row", "text").mapInArrow(_anchor_batches(parts), "part int, data binary")
    again = stored(blobs.repartitionById(parts, "part").select("data").mapInArrow(
        _repeated, "row long, hash long, place long, hot boolean"), "anchors")
    # A set: rows that repeat an id and a text have the same anchors.
    by_row = again.groupBy("row").agg(F.collect_set(F.struct("hash", "place", "hot")).alias("anchors"))  # of one text
    texts = found.join(by_row, "row").select("id", "row", "text", "anchors")
    shards = texts.mapInArrow(_cut(parts), "part int, data binary").repartitionById(parts, "part").select("data")
    spans = stored(shards.mapInArrow(_shard, SPANS), "spans")
    hot = spans.filter("text IS NOT NULL")
    # As many shards as an anchor's distinct pieces fill; the list of those with several is that much shorter than the pieces.
    many = hot.groupBy("hash").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards")).filter("shards > 1")
    dealt = hot.join(stored(many, "many"), "hash", "left").withColumn("shards", F.coalesce("shards", F.lit(1)))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("text"), F.col("shards"))).repartition("hash", "shard")
    compared = stored(dealt.sortWithinPartitions("hash", "shard", "text").mapInArrow(_hot_shards, SPANS), "compared")
    merged = stored(compared.filter("text IS NOT NULL").repartition("text").mapInArrow(_merge, SPANS), "merged")
    spans = spans.filter("text IS NULL").union(compared.filter("text IS NULL")).union(merged).select("row", "id", "start", "size")
    return stored(spans.distinct().groupBy("row", "id").agg(F.sort_array(F.collect_list(F.struct("start", "size"))).alias("spans")),
                  "removed")


def _kept(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and the maximal runs that go."""
    runs: list[list[int]] = []
    for s, n in spans:
        if runs and s <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], s + n)
        else:
            runs.append([s, s + n])
    out, at = [], 0
    for s, e in runs:
        out.append(text[at:s])
        at = e
    return b"".join([*out, text[at:]]), [(s, e) for s, e in runs]


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept binary, spans) of every row of ``docs``.

    ``kept`` has the bytes that are left, ``spans`` the maximal runs (start,
    end) that went.  Null and empty texts have no bytes.  Without rows the
    result is empty.  Other columns are not read.
    """
    spans = repeated_spans(docs, id_col, text_col)
    id_type = dict(docs.dtypes)[id_col]
    rows = _rows(docs, id_col, text_col, F.col(id_col).alias("given"))
    joined = rows.join(spans, ["row", "id"], "left").select("given", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), 1000):
                b = whole.slice(k, 1000)
                texts = [(t.as_py() or "").encode("utf-8", "replace") for t in b.column(1)]
                found = [[(s["start"], s["size"]) for s in x or ()] for x in b.column(2).to_pylist()]
                done = [_kept(t, s) for t, s in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    b.column(0), pa.array(map(len, texts), pa.int64()),
                    pa.array([len(t) - len(d[0]) for t, d in zip(texts, done, strict=True)], pa.int64()),
                    pa.array([len(d[1]) for d in done], pa.int64()), pa.array([d[0] for d in done], pa.binary()),
                    pa.array([[{"start": s, "end": e} for s, e in d[1]] for d in done],
                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    [id_col, "n_bytes", "n_removed", "n_spans", "kept", "spans"])

    return joined.mapInArrow(cut, f"`{id_col}` {id_type}, n_bytes long, n_removed long, n_spans long, kept binary, "
                                  "spans array<struct<start:long,end:long>>")

