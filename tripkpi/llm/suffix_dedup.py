"""Exact substring dedup with suffix arrays built by two-stage sorting.

Every byte covered by a 50-byte string that also starts in a document with a
smaller id is removed. Equal strings are brought together without a global
sort: each 50-byte window of a text names as its anchor the position of its
smallest 20-byte fingerprint (leftmost on ties), so that equal windows have
equal anchors; consecutive windows share one, about 16 at a time.

1. Anchors' fingerprints are dealt to buckets; only anchors whose fingerprint
   occurs in two documents go on. What repeats already within a task's slice
   of documents is known there and sends one entry for all.
2. For these, the bytes of their windows (50 to 80, equal ones once per slice)
   are dealt to buckets by fingerprint, each for its smallest document in the
   slice; of the slice's others the windows are covered, as is known there.
3. A bucket sorts all suffixes of its byte strings: directly only those that
   are smaller than their successors, the rest is induced by scanning the
   first-byte buckets in order. Adjacent common prefixes of 50 and more bytes
   mark equal windows, whose smallest document is compared with each other's.
4. Covered windows return to their documents.

The number of buckets follows the corpus' bytes, so a bucket's text is bounded;
common passages are combined before each shuffle. The texts are shuffled once,
to meet the positions found and, by the same exchange, the final spans.

Defined cases: null text has no bytes; texts under 50 bytes lose nothing; a
null id counts as larger than all others; rows that share an id (repeated rows
too) are not smaller than each other, and are told apart by their text; an
empty table gives no rows; input columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm import textvec as V
from tripkpi.llm.tables import bounded_batches

LENGTH = 50
GRAM = 20
SPAN = LENGTH - GRAM + 1
SLICE = 1 << 16
FLUSH = 4 << 20
BUCKET_BYTES = 8 << 20
MIN_BUCKETS = 64
LAST = (1 << 63) - 1

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_POS = _U(SLICE - 1)
_BYTE = np.random.Generator(np.random.Philox(key=[20, 50])).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


# --- two-stage suffix sorting ------------------------------------------------------------

def smallest_owner(pieces: list[np.ndarray] | np.ndarray, length: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For byte strings, laid end to end, with an owner each: per start of a 50-byte window the smallest owner
    of an equal window, and the first window of each string."""
    count = length - LENGTH + 1
    first = np.concatenate([[0], np.cumsum(count)])
    text, at = _with_ends(pieces, length)
    start = np.repeat(at, count) + (np.arange(first[-1]) - np.repeat(first[:-1], count))
    own = np.repeat(np.arange(len(length)), count)
    order = _two_stage(text, start, at + count - 1)
    window = np.full(len(text), -1, np.int64)
    window[start] = np.arange(len(start))
    order = window[order]
    order = order[order >= 0]
    same = _common(text, start[order[:-1]], start[order[1:]]) >= LENGTH
    group = np.concatenate([[0], np.cumsum(~same)]) if len(order) else np.zeros(0, np.int64)
    low = np.full(int(group[-1]) + 1 if len(group) else 0, LAST)
    np.minimum.at(low, group, owner[own[order]])
    out = np.empty(len(start), np.int64)
    out[order] = low[group]
    return out, first


def _with_ends(data: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings with a zero byte after each (bytes moved up by one) and room to read beyond, and their places."""
    at = np.cumsum(length + 1) - (length + 1)
    text = np.zeros(int((length + 1).sum()) + 64, np.uint8)
    text[np.arange(len(data)) + np.repeat(np.arange(len(length)), length)] = data + np.uint8(1)
    return text, at


def _eight(text: np.ndarray) -> np.ndarray:
    """Big-endian words of eight bytes at every position."""
    return np.ndarray((len(text) - 7,), ">u8", text, 0, (1,))


def _two_stage(text: np.ndarray, start: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Positions of the suffixes wanted (and some beyond) in lexical order, to at least 50 bytes."""
    n = len(text) - 64
    # a suffix is smaller than its successor if the next two bytes that differ rise
    rise = text[:n] < text[1:n + 1]
    differ = np.where(text[:n] != text[1:n + 1], np.arange(n), n - 1)
    smaller = rise[np.minimum.accumulate(differ[::-1])[::-1]]
    want = np.zeros(n + 1, bool)
    want[start] = True
    # an induced suffix needs its successor: the descent that a string's last window begins is wanted too
    more = last[~smaller[last]] + 1
    while len(more):
        want[more] = True
        more = more[(text[more] != 0)]
        more = more[~smaller[more]] + 1
    ends = np.flatnonzero(want[:n] & (text[:n] == 0))
    direct = np.flatnonzero(want[:n] & smaller & (text[:n] != 0))
    direct = _sort_direct(text, direct)
    cut = np.searchsorted(text[direct], np.arange(257))
    induced = want[:n] & ~smaller & (text[:n] != 0)

    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def scan(rows: np.ndarray, byte: int) -> np.ndarray:
        """Induce the predecessors of sorted suffixes; those of the same first byte are returned."""
        before = rows[rows > 0] - 1
        before = before[induced[before]]
        heads = text[before]
        same = before[heads == byte]
        others, heads = before[heads != byte], heads[heads != byte]
        if len(others):
            order = np.argsort(heads, kind="stable")
            others, heads = others[order], heads[order]
            where = np.flatnonzero(np.concatenate([[True], heads[1:] != heads[:-1]]))
            for b, part in zip(heads[where].tolist(), np.split(others, where[1:])):
                waiting[b].append(part)
        return same

    scan(ends, 0)
    for byte in range(1, 256):
        rows = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        while len(rows):
            out.append(rows)
            rows = scan(rows, byte)
        rows = direct[cut[byte]:cut[byte + 1]]
        if len(rows):
            out.append(rows)
            scan(rows, byte)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _sort_direct(text: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows by their next 56 bytes: by eight at a time, those still tied going on."""
    words = _eight(text)
    key = words[rows].astype(np.uint64)
    order = np.argsort(key)
    rows, key = rows[order], key[order]
    tied = np.zeros(len(rows), bool)
    head = np.concatenate([[True], key[1:] != key[:-1]])
    for depth in range(8, 56, 8):
        tied = ~head
        tied[:-1] |= ~head[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(head)[at]
        key = words[rows[at] + depth].astype(np.uint64)
        order = np.lexsort((key, group))
        rows[at] = rows[at][order]
        key, group = key[order], group[order]
        head[at] = np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
    return rows


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes a and b: whole words of eight bytes, then bytes, up to 56."""
    words = _eight(text)
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for depth in range(0, 56, 8):
        x = words[a[live] + depth].astype(np.uint64) ^ words[b[live] + depth].astype(np.uint64)
        equal = x == 0
        if depth + 8 > LENGTH:                  # whole words decide but for the last
            part = x[~equal]
            out[live[~equal]] += sum((part < (_U(1) << _U(64 - 8 * k))).astype(np.int64) for k in range(1, 8))
        live = live[equal]
        out[live] += 8
    return out


# --- anchors ---------------------------------------------------------------------------

def grams(data: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of every run of 20 bytes, by doubling."""
    h1 = _BYTE[data]
    b, hs = _BASE, {1: h1}
    for m in (1, 2, 4, 8):
        hs[2 * m] = hs[m][:-m] * b + hs[m][m:]
        b = np.multiply(b, b)
        if m == 2:
            b4 = b
    return V.mix(hs[16][:-4] * b4 + hs[4][16:])


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first window, windows, fingerprint) of each run of windows with one anchor."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    h = grams(data)
    low = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
    for m in (1, 2, 4, 8):
        low = np.minimum(low[:-m], low[m:])
    low = np.minimum(low[:n], low[SPAN - 16:SPAN - 16 + n])
    ends = np.repeat(bounds[1:], np.diff(bounds))
    p = np.flatnonzero(np.arange(n) + LENGTH <= ends[:n])
    if not len(p):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    a = (low[p] & _POS).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    lo = p[head]
    return np.searchsorted(bounds, lo, "right") - 1, lo, np.diff(np.append(head, len(p))), h[a[head]]


def pieces(data: np.ndarray, offsets: np.ndarray):
    """(first row, data, bounds, offset in the row): slices of whole rows, or overlapping parts of a long one."""
    for lo, hi in V.slices(offsets, SLICE):
        base, end = int(offsets[lo]), int(offsets[hi])
        if end - base <= SLICE:
            yield lo, data[base:end], (offsets[lo:hi + 1] - base).astype(np.int64), 0
            continue
        step = SLICE // 2
        for at in range(0, end - base - LENGTH + 1, step):
            part = data[base + at:min(end, base + at + step + LENGTH - 1)]
            yield lo, part, np.array([0, len(part)]), at


# --- step 1: anchors that occur in two documents ----------------------------------------

ASKS = "part int, kind int, prints binary, ids binary, los binary"
FOUND = "uid long, lo int"


def _ints(x: np.ndarray) -> bytes:
    """Differences of a sequence, in four bytes each where they fit (they compress well; places always do)."""
    d = np.diff(x, prepend=0)
    small = not len(d) or (d.min() >= -(1 << 31) and d.max() < 1 << 31)
    return d.astype("<i4" if small else "<i8").tobytes()


def _sums(raw: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<i4" if len(raw) == 4 * n else "<i8"), dtype=np.int64)


def _bucket(prints: np.ndarray, buckets: int) -> np.ndarray:
    return ((prints >> _U(32)) % _U(buckets)).astype(np.int64)


def _anywhere(uid: np.int64, n: int, buckets: int) -> int:
    """A bucket for the ``n``-th packet of a slice: by a row, as a common passage begins many slices."""
    return int((V.mix(np.array([uid]).astype(_U))[0] % _U(buckets) + _U(n)) % _U(buckets))


def _ask(buckets: int):
    """Slices of documents -> rows of fingerprints per bucket (kind 0) and of anchors known to repeat (kind 1)."""
    def flush(uid, lo, prints):
        uid, lo, prints = np.concatenate(uid), np.concatenate(lo), np.concatenate(prints)
        order = np.lexsort((uid, prints))
        u, p = uid[order], prints[order]
        head = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        last = np.append(head[1:], len(p)) - 1
        twice = u[head] != u[last]
        known = np.repeat(twice, last - head + 1)
        # one entry stands for all of a fingerprint that is known to repeat; it needs no answer (place -1)
        send = np.concatenate([order[~known], order[head[twice]]])
        place = np.concatenate([lo[order[~known]], np.full(int(twice.sum()), -1)])
        part = _bucket(prints[send], buckets)
        by = np.lexsort((place, uid[send], part))
        send, place, part = send[by], place[by], part[by]
        cut = np.searchsorted(part, np.arange(buckets + 1))
        rows = [(b, 0, (prints[send[i:j]] & _U(0xFFFFFFFF)).astype("<u4").tobytes(), _ints(uid[send[i:j]]), _ints(place[i:j]))
                for b, (i, j) in enumerate(zip(cut[:-1], cut[1:])) if j > i]
        known = np.sort(order[known])
        for n, i in enumerate(range(0, len(known), 1 << 15)):
            k = known[i:i + (1 << 15)]
            rows.append((_anywhere(uid[k[0]], n, buckets), 1, b"", _ints(uid[k]), _ints(lo[k])))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
            ["part", "kind", "prints", "ids", "los"])

    def run(batches):
        kept, held = ([], [], []), 0
        for b in batches:
            ids = np.asarray(b.column(0))
            data, offsets, _ = V.utf8(b.column(1))
            for first, part, bounds, at in pieces(data, offsets):
                row, lo, _, prints = anchors(part, bounds)
                if len(row):
                    kept[0].append(ids[first + row])
                    kept[1].append(lo - bounds[row] + at)
                    kept[2].append(prints)
                held += len(part)
                if held > FLUSH and kept[0]:
                    yield flush(*kept)
                    kept, held = ([], [], []), 0
        if kept[0]:
            yield flush(*kept)

    return run


def _by_part(batches, make):
    """Rows sorted by their first column: ``make`` gets all rows of one value at a time."""
    rows, now = [], None
    for b in batches:
        for r in b.to_pylist():
            if r["part"] != now and rows:
                yield from make(rows)
                rows = []
            now = r["part"]
            rows.append(r)
    if rows:
        yield from make(rows)


def _repeated(batches):
    """Answers of one bucket after another: the places of anchors whose fingerprint occurs in two documents."""
    def answer(rows):
        ask = [r for r in rows if r["kind"] == 0]
        out = [(_sums(r["ids"], len(r["los"]) // 4), _sums(r["los"], len(r["los"]) // 4)) for r in rows if r["kind"]]
        if ask:
            prints = np.concatenate([np.frombuffer(r["prints"], "<u4") for r in ask])
            uid = np.concatenate([_sums(r["ids"], len(r["prints"]) // 4) for r in ask])
            lo = np.concatenate([_sums(r["los"], len(r["prints"]) // 4) for r in ask])
            order = np.argsort(prints, kind="stable")
            p, u = prints[order], uid[order]
            head = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
            many = (np.minimum.reduceat(u, head) != np.maximum.reduceat(u, head)) | (np.minimum.reduceat(lo[order], head) < 0)
            hit = order[np.repeat(many, np.diff(np.append(head, len(p))))]
            hit = hit[lo[hit] >= 0]
            out.append((uid[hit], lo[hit]))
        for u, at in out:
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(at.astype(np.int32))], ["uid", "lo"])

    yield from _by_part(batches, answer)


# --- steps 2 and 3: windows of repeated anchors, sorted bucket by bucket -----------------

WINDOWS = "part int, kind int, bytes binary, lengths binary, which binary, ids binary, ranks binary, los binary"
MASKS = "uid long, lo int, mask long"


def _windows(buckets: int):
    """Documents with the places of their repeated anchors -> the windows' bytes, equal ones once and for their smallest
    rank only, per bucket (kind 0), and the anchors whose windows a smaller rank of the slice covers (kind 1)."""
    def flush(kept):
        raw, length, prints, uid, rank, lo = (np.concatenate(k) for k in kept)
        off = np.concatenate([[0], np.cumsum(length)])
        col = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(raw)])
        coded = col.dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        _, first = np.unique(code, return_index=True)                     # codes count up from 0
        least = np.full(len(first), LAST)
        np.minimum.at(least, code, rank)
        known = rank > least[code]
        part = _bucket(prints, buckets)
        by = np.lexsort((lo, uid, code, part))
        by = by[~known[by]]
        cut = np.searchsorted(part[by], np.arange(buckets + 1))
        rows = []
        for b, (i, j) in enumerate(zip(cut[:-1], cut[1:])):
            if j > i:
                rows_ = by[i:j]
                codes, which = np.unique(code[rows_], return_inverse=True)
                src = first[codes]
                at = np.repeat(off[src] - np.concatenate([[0], np.cumsum(length[src])[:-1]]), length[src])
                rows.append((b, 0, pa.compress(raw[at + np.arange(len(at))].tobytes(), "zstd", asbytes=True),
                             length[src].astype(np.uint8).tobytes(),
                             _ints(which), _ints(uid[rows_]), _ints(rank[rows_] - uid[rows_]), _ints(lo[rows_])))
        known = np.flatnonzero(known)
        known = known[np.lexsort((lo[known], uid[known]))]
        for n, i in enumerate(range(0, len(known), 1 << 15)):
            k = known[i:i + (1 << 15)]
            rows.append((_anywhere(uid[k[0]], n, buckets), 1, b"", length[k].astype(np.uint8).tobytes(), b"", _ints(uid[k]), b"",
                         _ints(lo[k])))
        types = (pa.int32(),) * 2 + (pa.binary(),) * 6
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                          [f.split()[0] for f in WINDOWS.split(", ")])

    def run(batches):
        kept, held = tuple([] for _ in range(6)), 0
        for b in batches:
            uid, rank = np.asarray(b.column(0)), np.asarray(b.column(1))
            data, offsets, _ = V.utf8(b.column(2).cast(pa.large_binary()).cast(pa.large_string()))
            los = b.column(3)
            spot, spots = np.asarray(los.flatten()).astype(np.int64), np.asarray(pa.compute.list_value_length(los))
            owner = np.repeat(np.arange(b.num_rows), spots)
            wanted = np.sort((owner << 32) | spot)
            for first, part, bounds, at in pieces(data, offsets):
                row, lo, count, prints = anchors(part, bounds)
                place = lo - bounds[row] + at
                pick = np.flatnonzero(_member((first + row << 32) | place, wanted))
                if not len(pick):
                    continue
                length = count[pick] + LENGTH - 1
                begin = np.repeat(lo[pick] - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
                for k, x in zip(kept, (part[begin + np.arange(len(begin))], length, prints[pick], uid[first + row[pick]],
                                       rank[first + row[pick]], place[pick])):
                    k.append(x)
                held += len(begin)
                if held > FLUSH:
                    yield flush(kept)
                    kept, held = tuple([] for _ in range(6)), 0
        if held:
            yield flush(kept)

    return run


def _member(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, x)
    return (at < len(known)) & (known[np.minimum(at, len(known) - 1)] == x) if len(known) else np.zeros(len(x), bool)


def _covered(batches):
    """Per anchor, the windows (bits from its first) that a document with a smaller rank has too."""
    def masks(uid, lo, mask):
        return pa.RecordBatch.from_arrays([pa.array(uid), pa.array(lo.astype(np.int32)), pa.array(mask)], ["uid", "lo", "mask"])

    def judge(rows):
        for r in rows:
            if r["kind"]:
                n = len(r["los"]) // 4
                count = np.frombuffer(r["lengths"], np.uint8).astype(np.int64) - (LENGTH - 1)
                yield masks(_sums(r["ids"], n), _sums(r["los"], n), (np.int64(1) << count) - 1)
        rows = [r for r in rows if not r["kind"]]
        if not rows:
            return
        lengths = [np.frombuffer(r["lengths"], np.uint8).astype(np.int64) for r in rows]
        length = np.concatenate(lengths)
        raw = np.concatenate([np.frombuffer(pa.decompress(r["bytes"], int(k.sum()), "zstd"), np.uint8)
                              for r, k in zip(rows, lengths)])
        base = np.cumsum([0] + [len(r["lengths"]) for r in rows])
        n = [len(r["los"]) // 4 for r in rows]
        which = np.concatenate([_sums(r["which"], k) + b for r, k, b in zip(rows, n, base)])
        uid = np.concatenate([_sums(r["ids"], k) for r, k in zip(rows, n)])
        rank = uid + np.concatenate([_sums(r["ranks"], k) for r, k in zip(rows, n)])
        lo = np.concatenate([_sums(r["los"], k) for r, k in zip(rows, n)])
        # equal byte strings of different slices become one, owned by their smallest rank
        off = np.concatenate([[0], np.cumsum(length)])
        code = np.asarray(pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(length), [None, pa.py_buffer(off), pa.py_buffer(raw)]).dictionary_encode().indices).astype(np.int64)
        _, src = np.unique(code, return_index=True)
        which = code[which]
        owner = np.full(len(src), LAST)
        np.minimum.at(owner, which, rank)
        at = np.repeat(off[src] - np.concatenate([[0], np.cumsum(length[src])[:-1]]), length[src])
        low, first = smallest_owner(raw[at + np.arange(len(at))], length[src], owner)
        count = np.diff(first)
        table = np.full((len(src), SPAN), LAST)
        table[np.repeat(np.arange(len(src)), count), np.arange(len(low)) - np.repeat(first[:-1], count)] = low
        for i in range(0, len(which), 1 << 16):
            k = slice(i, i + (1 << 16))
            mask = (table[which[k]] < rank[k, None]) @ (np.int64(1) << np.arange(SPAN))
            hit = np.flatnonzero(mask)
            yield masks(uid[k][hit], lo[k][hit], mask[hit])

    yield from _by_part(batches, judge)


# --- step 4: back to the documents -------------------------------------------------------

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<lo:long,hi:long>>"


def _spans(n: int, los: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """(runs, 2): the bytes under the covered windows."""
    bits = (masks[:, None] >> np.arange(SPAN)) & 1
    r, j = np.nonzero(bits)
    at = np.unique(los[r] + j)
    if not len(at):
        return np.zeros((0, 2), np.int64)
    new = np.flatnonzero(np.concatenate([[True], at[1:] > at[:-1] + LENGTH]))
    return np.stack([at[new], np.append(at[new[1:] - 1], at[-1]) + LENGTH], 1)


def _remove(texts: bool):
    def run(batches):
        for b in batches:
            data, offsets, _ = V.utf8(b.column(1).cast(pa.large_binary()).cast(pa.large_string()))
            out = []
            for i, found in enumerate(b.column(2).to_pylist()):
                text = data[offsets[i]:offsets[i + 1]]
                spans = np.zeros((0, 2), np.int64)
                if found:
                    spans = _spans(len(text), np.array([f["lo"] for f in found]), np.array([f["mask"] for f in found], np.int64))
                keep = text
                if len(spans):
                    mark = np.zeros(len(text) + 1, np.int8)
                    mark[spans[:, 0]] = 1
                    mark[spans[:, 1]] -= 1
                    keep = text[np.cumsum(mark[:-1], dtype=np.int8) == 0]
                keep = keep.tobytes()
                out.append((len(text), len(text) - len(keep), len(spans), hashlib.sha256(keep).hexdigest(),
                            keep if texts else None, [{"lo": x, "hi": y} for x, y in spans.tolist()] if texts else None))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
                     pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array([o[k] for o in out], t) for k, t in enumerate(types)],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])
    return run


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """Per document: bytes, removed bytes and spans, the digest of what is kept, and (``texts``) the kept bytes and spans."""
    bounded_batches(docs)
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    size, rows, named = docs.agg(F.sum(F.octet_length(text)), F.count("*"), F.count_distinct(doc_id)).first()
    buckets = max(MIN_BUCKETS, -(-(size or 0) // BUCKET_BYTES))
    # ids name rows where they are unique; else a hash of id and text does
    uid = F.coalesce(doc_id, F.lit(LAST)) if rows == named else F.xxhash64(doc_id, text)
    src = docs.select(uid.alias("uid"), F.coalesce(doc_id, F.lit(LAST)).alias("rank"), doc_id.alias("doc_id"),
                      F.coalesce(text, F.lit("")).cast("binary").alias("raw"))
    asks = src.select("uid", F.col("raw").cast("string").alias("text")).mapInArrow(_ask(buckets), ASKS)
    found = asks.repartition(buckets, "part").sortWithinPartitions("part").mapInArrow(_repeated, FOUND)
    places = found.groupBy("uid").agg(F.collect_set("lo").alias("los")).withColumnRenamed("uid", "found_uid")
    # both joins take all of src's columns and uid is never null, so that its exchange is made once and used again
    candidates = src.join(places, F.col("uid") == F.col("found_uid")).select("uid", "rank", "raw", "los", "doc_id")
    windows = candidates.mapInArrow(_windows(buckets), WINDOWS)
    masks = windows.repartition(buckets, "part").sortWithinPartitions("part").mapInArrow(_covered, MASKS)
    gone = masks.groupBy("uid").agg(F.collect_set(F.struct("lo", "mask")).alias("gone")).withColumnRenamed("uid", "gone_uid")
    both = src.join(gone, F.col("uid") == F.col("gone_uid"), "left").select("doc_id", "raw", "gone", "uid", "rank")
    return both.mapInArrow(_remove(texts), RESULT)
