"""Spelling variant grouping by k-d trees over letter-count vectors.

Words are the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased.
(An occurrence whose checksum ``SLIP_EVERY`` divides loses one letter first:
planted misspellings.) Two words are near if exactly one letter is inserted,
deleted or replaced. Then their letter-count vectors differ by 1 in one letter
(lengths one apart), or by 1 up in one and 1 down in another letter (equal
lengths): an L1 distance of at most two. So near words are found by range
searches in that space, one for each pair of lengths:

* for each length, a k-d tree fitted to a bounded sample of words splits the
  space into cells, so many that a cell holds about ``CELL_WORDS`` words;
  a cell with more is dealt to parts by hash;
* each word is a member of one part of one cell, and a query at every cell of
  its own length and of the length below that its ball reaches: on the way
  down each split adds what the query's count lies over or under the side's
  bounds, and a side is pruned when more than 1 over or under is needed
  (none under, for the length below);
* in a part, the members' distinct vectors form a k-d tree down to leaves of
  ``LEAF``; queries pass it in batches under the same pruning, and at the
  leaves a parity mask and then the counts are compared;
* letter order is verified by hash look-up: the differing letters are known,
  so each spelling that the query can become (drop one of its x; put y for one
  of its x) is looked up among the members.

A part sums up per word how many near words it has and the best of them, and
the sums are combined map-side, so no list of pairs is made. ``form`` points to
a word at least ``RATIO`` times as frequent; roots follow by pointer doubling.

The driver sees word counts per length and the samples (``SAMPLE`` words per
length, or ``SAMPLE_PER_CELL`` for each cell); the cells' splits are broadcast,
under 100 bytes for each ``CELL_WORDS`` distinct words.

Defined cases: null and empty texts have no words; a null id reads as empty in
the checksum; repeated rows count again; ties go to the smaller word in code
point order; a table without words gives no rows; other input columns are
ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm.tables import Shared, bounded_batches, staged
from tripkpi.llm.textvec import LOWER, slices, utf8

SLIP_EVERY = 199
MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5
CELL_WORDS = 1 << 14
SAMPLE = 1 << 14
SAMPLE_PER_CELL = 32
LEAF = 16
HELD_WORDS = 1 << 17
QUERY_BATCH = 1 << 13
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
PLACE = {c: k for k, c in enumerate(LETTERS)}
WIDTH = len(LETTERS)


# --- words and their counts ---------------------------------------------------

def runs(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the letter runs in UTF-8 bytes; rows are raw[bounds[i]:bounds[i + 1]]."""
    inside = ((raw | 32) >= 97) & ((raw | 32) <= 122) | (raw == 0xC3)
    inside[1:] |= raw[:-1] == 0xC3                       # U+00C0 to U+00FF: 0xC3 and one more byte
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:len(raw)]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:len(raw)]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(bounds, start, "right") - 1


def slipped(doc_id: bytes, word: bytes, every: int = SLIP_EVERY) -> bytes:
    """The word, or without one letter where ``every`` divides the checksum of ``<doc_id>:<word>``."""
    h = zlib.crc32(doc_id + b":" + word)
    if h % every:
        return word
    text = word.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1:]).encode()


def _letters(word: bytes) -> int:
    return len(word) - word.count(b"\xc3")


def word_counts(docs: DataFrame, id_col: str, text_col: str, min_letters: int, every: int) -> DataFrame:
    """(word, n) of all occurrences: summed per task in a bounded table, then map-side, then by word."""
    src = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"),
                      F.col(text_col).cast("string").alias("text")).where("text is not null")

    def count(batches):
        held: dict[bytes, int] = {}
        for b in batches:
            data, offsets, _ = utf8(b.column(1))
            names = [x.encode() for x in b.column(0).to_pylist()]
            for lo, hi in slices(offsets):
                raw = LOWER[data[offsets[lo]:offsets[hi]]]
                start, end, row = runs(raw, offsets[lo:hi + 1] - offsets[lo])
                long = end - start >= min_letters
                start, end, row, flat = start[long], end[long], row[long], raw.tobytes()
                cut = np.searchsorted(row, np.arange(hi - lo + 1)).tolist()
                start, end = start.tolist(), end.tolist()
                for r in range(hi - lo):
                    own: dict[bytes, int] = {}
                    for k in range(cut[r], cut[r + 1]):
                        w = flat[start[k]:end[k]]
                        own[w] = own.get(w, 0) + 1
                    name = names[lo + r]
                    for w, n in own.items():
                        w = slipped(name, w, every)
                        if len(w) >= min_letters and _letters(w) >= min_letters:
                            held[w] = held.get(w, 0) + n
                    if len(held) > HELD_WORDS:
                        yield _counted(held)
                        held = {}
        yield _counted(held)

    def _counted(held):
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()),
                                           pa.array(list(held.values()), pa.int64())], ["word", "n"])

    return src.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --- vectors and trees ----------------------------------------------------------

def vectors(words: list[str]) -> np.ndarray:
    """Letter counts, one row a word."""
    out = np.zeros((len(words), WIDTH), np.int32)
    joined = "".join(words)
    letters = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    place = np.where(letters >= 0xC0, letters - 0xC0 + 26, letters - 97)
    rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
    np.add.at(out, (rows, place), 1)
    return out


def fit_splits(points: np.ndarray, cells: int) -> list[tuple[int, int, int, int]]:
    """A k-d tree as rows (letter, bound, left, right): counts up to the bound go left; a negative child -1 - c is cell c.

    Each split takes the letter and bound that halve the points best, among the
    letters that vary most. Equal points are not split.
    """
    nodes: list[tuple[int, int, int, int]] = []
    made = [0]

    def leaf() -> int:
        made[0] += 1
        return -made[0]

    def grow(p: np.ndarray, want: int) -> int:
        split = best_split(p) if want > 1 else None
        if split is None:
            return leaf()
        at = len(nodes)
        nodes.append((0, 0, 0, 0))
        low = p[:, split[0]] <= split[1]
        share = max(1, min(want - 1, round(want * np.count_nonzero(low) / len(p))))
        left = grow(p[low], share)
        nodes[at] = (*split, left, grow(p[~low], want - share))
        return at

    grow(points, cells)
    return nodes


def best_split(p: np.ndarray) -> tuple[int, int] | None:
    """The letter and bound that part the points most evenly; None if all are equal."""
    if len(p) < 2:
        return None
    found, score = None, 0
    spread = p.max(0) - p.min(0)
    varied = np.flatnonzero(spread)
    if not len(varied):
        return None
    std = p[:, varied].std(0)
    for d in varied[np.argsort(-std, kind="stable")[:12]].tolist():
        column = p[:, d]
        for bound in range(int(column.min()), int(column.max())):
            low = np.count_nonzero(column <= bound)
            even = min(low, len(p) - low)
            if even > score:
                found, score = (d, bound), even
    return found


def home(nodes, points: np.ndarray) -> np.ndarray:
    """The cell of each point."""
    out = np.zeros(len(points), np.int64)
    todo = [(0, np.arange(len(points)))] if nodes else []
    while todo:
        at, rows = todo.pop()
        if at < 0:
            out[rows] = -1 - at
            continue
        d, bound, left, right = nodes[at]
        low = points[rows, d] <= bound
        todo += [(left, rows[low]), (right, rows[~low])]
    return out


def reached(nodes, points: np.ndarray, over: int, under: int):
    """Yields (cell, rows of the points): cells that hold vectors the point exceeds by ``over`` at most, and is under by ``under``."""
    n = len(points)
    if not nodes:
        yield 0, np.arange(n)
        return
    inf = 1 << 20
    todo = [(0, np.arange(n), np.zeros(n, np.int32), np.zeros(n, np.int32), {})]
    while todo:
        at, rows, high, low, box = todo.pop()
        if not len(rows):
            continue
        if at < 0:
            yield -1 - at, rows
            continue
        d, bound, left, right = nodes[at]
        lo, hi = box.get(d, (0, inf))
        x = points[rows, d]
        was_over, was_under = np.maximum(x - hi, 0), np.maximum(lo - x, 0)
        more = high + np.maximum(x - bound, 0) - was_over             # into counts of lo to bound
        ok = more <= over
        todo.append((left, rows[ok], more[ok], low[ok], {**box, d: (lo, bound)}))
        less = low + np.maximum(bound + 1 - x, 0) - was_under         # into counts of bound + 1 to hi
        ok = less <= under
        todo.append((right, rows[ok], high[ok], less[ok], {**box, d: (bound + 1, hi)}))


class Part:
    """The members of one part of a cell: words of one length, searchable by near words."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.counts = words, counts
        self.index = {w: k for k, w in enumerate(words)}
        self.length = len(words[0]) if words else 0
        self.bags = np.unique(vectors(words), axis=0) if words else np.zeros((0, WIDTH), np.int32)
        self.odd = parity(self.bags)
        self.nodes = fit_splits(self.bags, max(1, len(self.bags) // LEAF))
        cell = home(self.nodes, self.bags)
        order = np.argsort(cell, kind="stable")
        edges = np.searchsorted(cell[order], np.arange(int(cell.max(initial=0)) + 2))
        self.leaves = [order[a:b] for a, b in zip(edges[:-1], edges[1:])]

    def near(self, words: list[str]):
        """Yields (number of the query, number of the member) for each near pair; queries have one length."""
        if not words or not self.words:
            return
        same = len(words[0]) == self.length
        bags, which = np.unique(vectors(words), axis=0, return_inverse=True)
        odd = parity(bags)
        order = np.argsort(which.ravel(), kind="stable")
        edges = np.searchsorted(which.ravel()[order], np.arange(len(bags) + 1))
        for leaf, rows in reached(self.nodes, bags, 1, 1 if same else 0):
            members = self.leaves[leaf]
            for at in range(0, len(rows), 1024):
                some = rows[at:at + 1024]
                differ = np.bitwise_count(odd[some, None] ^ self.odd[None, members])
                q, m = np.nonzero(differ <= 2)
                gap = bags[some[q]] - self.bags[members[m]]
                off = np.abs(gap).sum(1)
                for k in np.flatnonzero(off == (2 if same else 1)).tolist():
                    bag = some[q[k]]
                    drop = LETTERS[int(np.argmax(gap[k]))]
                    put = LETTERS[int(np.argmin(gap[k]))] if same else ""
                    for word in order[edges[bag]:edges[bag + 1]].tolist():
                        for other in respelled(words[word], drop, put):
                            found = self.index.get(other)
                            if found is not None:
                                yield word, found


def parity(bags: np.ndarray) -> np.ndarray:
    """64 bits: which letters (their numbers modulo 64) occur an odd number of times."""
    bit = np.uint64(1) << (np.arange(WIDTH, dtype=np.uint64) & np.uint64(63))
    return np.bitwise_xor.reduce(np.where(bags & 1, bit, np.uint64(0)), axis=1) if len(bags) else np.zeros(0, np.uint64)


def respelled(word: str, drop: str, put: str) -> set[str]:
    """The spellings with one ``drop`` taken out and ``put`` in its place."""
    out, at = set(), word.find(drop)
    while at >= 0:
        out.add(word[:at] + put + word[at + 1:])
        at = word.find(drop, at + 1)
    return out


# --- the distributed search ---------------------------------------------------------

def cell_trees(words: DataFrame, cell_words: int, sample: int) -> dict[int, list[tuple[int, int, int, int]]]:
    """Per length the splits of its cells, fitted to a sample drawn by the words' hashes."""
    sizes = {r["length"]: r["n"] for r in words.groupBy("length").agg(F.count("*").alias("n")).collect()}
    cells = {k: -(-n // cell_words) for k, n in sizes.items()}
    split = [k for k, c in cells.items() if c > 1]
    if not split:
        return {}
    rate = None
    for k in split:
        share = min(1.0, max(sample, SAMPLE_PER_CELL * cells[k]) / sizes[k])
        rate = F.when(F.col("length") == k, share) if rate is None else rate.when(F.col("length") == k, share)
    u = F.pmod(F.xxhash64("word", F.lit("sample")), F.lit(1 << 52)) / float(1 << 52)
    drawn: dict[int, list[str]] = {}
    for r in words.where(F.col("length").isin(split) & (u < rate)).select("length", "word").orderBy("word").collect():
        drawn.setdefault(r[0], []).append(r[1])
    return {k: fit_splits(vectors(ws), cells[k]) for k, ws in drawn.items()}


PLACED = "length int, cell int, query boolean, word string, n long"


def placements(words: DataFrame, trees: Shared) -> DataFrame:
    """Each word as the member of its cell, and as a query at every cell in reach."""
    def place(batches):
        for b in batches:
            held = trees.value
            spelled, counts = b.column(0).to_pylist(), np.asarray(b.column(1))
            size = np.asarray(b.column(2))
            for length in np.unique(size).tolist():
                rows = np.flatnonzero(size == length)
                points = vectors([spelled[k] for k in rows])
                own = held.get(length, [])
                cell = home(own, points)
                yield _placed(length, cell, False, rows, spelled, counts)
                for to, under in ((length, 1), (length - 1, 0)):
                    for c, some in reached(held.get(to, []), points, 1, under):
                        yield _placed(to, np.full(len(some), c), True, rows[some], spelled, counts)

    def _placed(length, cell, query, rows, spelled, counts):
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, length), pa.int32()), pa.array(cell, pa.int32()), pa.array(np.full(n, query)),
             pa.array([spelled[k] for k in rows], pa.string()), pa.array(counts[rows], pa.int64())],
            [f.split()[0] for f in PLACED.split(", ")])

    return words.select("word", "n", "length").mapInArrow(place, PLACED)


FOUND = "word string, n_near long, best_n long, best string"


def search(placed: DataFrame, cell_words: int) -> DataFrame:
    """(word, n_near, best_n, best) per part that has near words of the word."""
    spark = placed.sparkSession
    full = placed.where("not query").groupBy("length", "cell").agg(F.count("*").alias("members"))
    full = full.select("length", "cell", F.ceil(F.col("members") / cell_words).cast("int").alias("parts"))
    # a cell without members is no one's target; a query visits every part of a cell
    dealt = placed.join(full, ["length", "cell"]).select(
        "length", "cell", "query", "word", "n",
        F.explode(F.when(F.col("query"), F.sequence(F.lit(0), F.col("parts") - 1))
                  .otherwise(F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")))).alias("part"))
    dealt = dealt.withColumn("unit", F.concat_ws("/", "length", "cell", "part"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = dealt.repartition(tasks, "unit").sortWithinPartitions("unit", "query", F.length("word"))

    def look(batches):
        unit, part, words, counts = None, None, [], []
        best: dict[str, tuple[int, int, str]] = {}

        def found():
            rows = [(w, *v) for w, v in best.items()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.string(), pa.int64(), pa.int64(), pa.string()))], [f.split()[0] for f in FOUND.split(", ")])

        def note(word, other, n):
            near, top, name = best.get(word, (0, -1, ""))
            if n > top or n == top and other < name:
                top, name = n, other
            best[word] = (near + 1, top, name)

        def ask(queries, weights):
            for lo in range(0, len(queries), QUERY_BATCH):
                some = queries[lo:lo + QUERY_BATCH]
                for q, m in part.near(some):
                    note(some[q], part.words[m], part.counts[m])
                    if len(some[q]) != part.length:      # a pair of two lengths is met once: both learn of it
                        note(part.words[m], some[q], weights[lo + q])

        for b in batches:
            units, asks = b.column(0).to_pylist(), b.column(1).to_pylist()
            spelled, weight = b.column(2).to_pylist(), b.column(3).to_pylist()
            at = 0
            while at < len(units):
                to = at
                while to < len(units) and units[to] == units[at] and asks[to] == asks[at] and (
                        not asks[at] or len(spelled[to]) == len(spelled[at])):
                    to += 1
                if units[at] != unit:
                    unit, part, words, counts = units[at], None, [], []
                    yield found()
                    best = {}
                if not asks[at]:
                    words += spelled[at:to]
                    counts += weight[at:to]
                else:
                    part = part or Part(words, counts)
                    ask(spelled[at:to], weight[at:to])
                at = to
            if len(best) > 2 * HELD_WORDS:
                yield found()
                best = {}
        yield found()

    parts = dealt.select("unit", "query", "word", "n").mapInArrow(look, FOUND)
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("k"), "best")).alias("top"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the last word reached by following ``form``; pointer doubling, each round written out."""
    at = staged(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        far = at.select(F.col("word").alias("step"), F.col("root").alias("next"))
        moved = at.join(far, at["root"] == far["step"], "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        done = staged(moved, "roots")
        at = done.select("word", "root")
        if done.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, *, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = RATIO,
                      every: int = SLIP_EVERY, cell_words: int = CELL_WORDS, sample: int = SAMPLE, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per word: its form, its root, its count, how many near words it has, its form's count."""
    bounded_batches(docs)
    words = word_counts(docs, id_col, text_col, min_letters, every).where(F.col("n") >= min_count)
    words = staged(words.withColumn("length", F.length("word")), "spelling-words")
    trees = Shared(docs.sparkSession, cell_trees(words, cell_words, sample))
    placed = staged(placements(words, trees), "spelling-placed")
    near = search(placed, cell_words)
    known = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("top.k") >= ratio * F.col("n"), F.col("top")).alias("top")).select(
        "word", F.col("top.best").alias("form"), "n", "n_near", (-F.col("top.k")).alias("form_n")), "spelling-forms")
    last = roots(known.where("form is not null").select("word", "form"))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
