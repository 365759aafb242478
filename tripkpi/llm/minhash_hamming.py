"""MinHash near-dedup by a multi-index Hamming join.

A document's set is its distinct shingles of five words (64-bit fingerprints).
Documents with equal sets are one class, represented by its smallest id. A
class's signature has symbols of 16 bits, each taken from the minimum of one
hash function, in chunks of ``SPAN``. Two sets of similarity s differ in about
a share of 1 - s of the symbols; the join finds every pair that differs in less
than twice as many symbols as there are chunks. By the pigeonhole principle
such a pair differs in at most one symbol inside at least one of the chunks, so
each signature is indexed under every chunk with each one of its symbols left
out, and pairs that share an index key are all pairs under the distance.

``percent`` is the least similarity of a link. ``symbols_for`` takes as many
symbols as a pair of just that similarity needs to differ in too many, which
the join would miss, with a probability of ``MISS`` at most: for 85, op1's, 40
(``SYMBOLS``, ``CHUNKS``, ``MAX_DIFF``; more than 19 differ with probability
2e-7), for 80 60 (more than 29: 2e-7). Above that similarity it is far less.

Keys shared by one class only are dropped after a map-side combined count.
Inside a key, signatures are compared by distance and by an exact bound on the
intersection (counts of the set's fingerprints in 256 cells); a pair is judged
under its first shared key only. Not all pairs are emitted: each class proposes its
best partners in other components (``FIRST`` at first, then 16 times as many
each round), the proposals are confirmed on the full sets, components are
formed, and keys whose classes are all in one component rest.

A key of more than ``BLOCK`` classes is dealt to blocks of about that many. In
the first round each block stays by itself, which joins most of a group of near
copies. From the second on, the classes outside the key's largest component
meet each other and those inside, block by block, while those inside are not
compared again: the work on a group of m near copies of which r are still
outside is r * m, not m * m. Classes that share a hot key and link with nothing
stay outside, so m * m is still met by many texts that are alike but under the
similarity. The rounds end when all blocks have met and no proposal was held
back, so no link between components is lost, however large the group.

Defined cases: text without words and null text have an empty set and link to
nothing; fewer words than five are one shingle; equal rows are one class; a
null id is returned with a null component and kept false; rows that share an
id are one node; an empty table gives no rows; input columns other than id and
text are ignored.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripkpi.llm import textvec as V
from tripkpi.llm.components import components
from tripkpi.llm.tables import bounded_batches, staged

SHINGLE = 5
PERCENT = 85
SPAN = 4
MISS = 2.2e-7
CELLS = 256
BLOCK = 512
FIRST, GROWTH = 2, 16


def symbols_for(percent: int) -> int:
    """The fewest symbols (whole chunks) with which the join misses a pair of ``percent`` with probability ``MISS`` at most."""
    p = 1 - percent / 100
    for n in range(SPAN, 257, SPAN):
        if sum(comb(n, k) * p**k * (1 - p)**(n - k) for k in range(2 * (n // SPAN), n + 1)) <= MISS:
            return n
    raise ValueError(f"no signature of 256 symbols or less finds pairs of {percent} %")


SYMBOLS = symbols_for(PERCENT)
CHUNKS = SYMBOLS // SPAN
MAX_DIFF = 2 * CHUNKS - 1


_HASHES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _hashes(symbols: int) -> tuple[np.ndarray, np.ndarray]:
    if symbols in _HASHES:
        return _HASHES[symbols]
    rng = np.random.Generator(np.random.Philox(key=[71, 5]))
    mult = rng.integers(1, 1 << 63, symbols, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return _HASHES.setdefault(symbols, (mult, rng.integers(0, 1 << 63, symbols, dtype=np.uint64)))


def signature(shingles: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """``symbols`` 16-bit symbols: the low bits of the minimum under each hash function."""
    mult, xor = _hashes(symbols)
    low = np.full(symbols, ~np.uint64(0))
    for at in range(0, len(shingles), 4096):
        x = (shingles[at:at + 4096, None] ^ xor) * mult
        x ^= x >> np.uint64(29)
        low = np.minimum(low, x.min(0))
    return (V.mix(low) & np.uint64(0xFFFF)).astype("<u2")


def cells(shingles: np.ndarray) -> np.ndarray:
    """Counts per cell, saturated; the sum of two sets' minima bounds their intersection while none saturates."""
    return np.minimum(np.bincount((shingles >> np.uint64(56)).astype(np.int64), minlength=CELLS), 255).astype(np.uint8)


SETS = "doc_id long, n_shingles long, digest binary, signature binary, cells binary"


def sets(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: set size, set digest, signature and cell counts (null for an empty set)."""
    symbols = symbols_for(percent)

    def build(batches):
        for b in batches:
            ids = b.column(0)
            data, offsets, _ = V.utf8(b.column(1))
            for lo, hi in V.slices(offsets):
                w = V.Words(data, offsets, lo, hi, V.SPACED)
                out = w.shingles(w.hashes(), size)
                full = [len(s) > 0 for s in out]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo), pa.array([len(s) for s in out], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if f else None for s, f in zip(out, full)], pa.binary()),
                    pa.array([signature(s, symbols).tobytes() if f else None for s, f in zip(out, full)], pa.binary()),
                    pa.array([cells(s).tobytes() if f else None for s, f in zip(out, full)], pa.binary())],
                    ["doc_id", "n_shingles", "digest", "signature", "cells"])

    return docs.mapInArrow(build, SETS)


def shingle_sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, shingles): the full sets as sorted fingerprints."""
    def build(batches):
        for b in batches:
            data, offsets, _ = V.utf8(b.column(1))
            for lo, hi in V.slices(offsets):
                w = V.Words(data, offsets, lo, hi, V.SPACED)
                out = w.shingles(w.hashes(), size)
                flat = np.concatenate([np.zeros(0, np.uint64), *out]).view(np.int64)
                cut = np.concatenate([[0], np.cumsum([len(s) for s in out])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(cut, flat)],
                                                 ["doc_id", "shingles"])

    return docs.mapInArrow(build, "doc_id long, shingles array<long>")


def index_keys(reps: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(key, key_no, rep): every chunk of every signature with each one of its symbols left out."""
    def explode(batches):
        for b in batches:
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u2").reshape(-1, symbols).astype(np.uint64)
            ids = np.asarray(b.column(0))
            for no in range(symbols):
                yield pa.RecordBatch.from_arrays([pa.array(_key(sig, no).view(np.int64)), pa.array(np.full(len(ids), no, np.int16)),
                                                  pa.array(ids)], ["key", "key_no", "rep"])

    return reps.select("rep", "signature").mapInArrow(explode, "key long, key_no short, rep long")


def _key(sig: np.ndarray, no: int) -> np.ndarray:
    """Index key ``no``: the symbols of chunk no // SPAN but the one numbered no % SPAN."""
    chunk = no // SPAN
    k = np.full(len(sig), no + 1, np.uint64)
    for j in range(SPAN):
        if j != no % SPAN:
            k = V.mix(k * np.uint64(65599) + sig[:, chunk * SPAN + j])
    return k


def proposals(units: DataFrame, top: int, percent: int = PERCENT) -> DataFrame:
    """(a, b, bound, held): for each class and unit the ``top`` best partners in components of smaller label.

    ``held`` is true on a row whose class had further partners. Units arrive
    sorted; pairs are formed by comparing each row with its d-th successor in
    the unit, for all rows of a batch at once.
    """
    symbols = symbols_for(percent)

    def run(batches):
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
            unit = t.column("unit").to_numpy()
            cut = int(np.searchsorted(unit, unit[-1], "left")) if len(unit) else 0
            if cut:
                yield from _pairs(t.slice(0, cut), top, percent, symbols)
            rest = t.slice(cut)
        if rest is not None and rest.num_rows:
            yield from _pairs(rest, top, percent, symbols)

    return units.mapInArrow(run, "a long, b long, bound double, held boolean")


def _pairs(t: pa.Table, top: int, percent: int, symbols: int):
    unit, side, key_no = (t.column(c).to_numpy() for c in ("unit", "side", "key_no"))
    rep, comp, n = (t.column(c).to_numpy() for c in ("rep", "component", "n"))
    sig = np.frombuffer(b"".join(t.column("signature").to_pylist()), "<u2").reshape(-1, symbols)
    cell = np.frombuffer(b"".join(t.column("cells").to_pylist()), np.uint8).reshape(-1, CELLS)
    lo, hi, best = [], [], []
    live = np.arange(len(unit) - 1)
    d = 0
    while len(live):
        d += 1
        live = live[live + d < len(unit)]
        live = live[unit[live] == unit[live + d]]
        # two blocks meet in a unit of sides 0 and 1; inside a block (side 2) all meet
        go = live[((side[live] == 2) | (side[live] != side[live + d])) & (comp[live] != comp[live + d])]
        go = go[100 * np.minimum(n[go], n[go + d]) >= percent * np.maximum(n[go], n[go + d])]
        for at in range(0, len(go), 1 << 15):
            i = go[at:at + (1 << 15)]
            j = i + d
            same = sig[i] == sig[j]
            near = (~same).sum(1) < 2 * (symbols // SPAN)
            i, j, same = i[near], j[near], same[near]
            first = _first_key(same) == key_no[i]
            i, j = i[first], j[first]
            common = np.minimum(cell[i], cell[j]).sum(1, dtype=np.int64)
            # a saturated cell bounds nothing: such (very long) sets go on to the full check
            common = np.where((cell[i].max(1, initial=0) == 255) & (cell[j].max(1, initial=0) == 255),
                              np.minimum(n[i], n[j]), common)
            union = n[i] + n[j] - common
            ok = 100 * common >= percent * union
            lo.append(i[ok])
            hi.append(j[ok])
            best.append((common / union)[ok])
    if not lo:
        return
    i, j, s = np.concatenate(lo), np.concatenate(hi), np.concatenate(best)
    up = comp[i] > comp[j]
    x, y = np.where(up, i, j), np.where(up, j, i)         # x proposes y, whose component is smaller
    order = np.lexsort((rep[y], -s, x))
    x, y = x[order], y[order]
    place = np.arange(len(x)) - np.searchsorted(x, x, "left")
    total = np.searchsorted(x, x, "right") - np.searchsorted(x, x, "left")
    keep = place < top
    yield pa.RecordBatch.from_arrays([pa.array(rep[x[keep]]), pa.array(rep[y[keep]]), pa.array(s[order][keep]),
                                      pa.array((total > top)[keep])], ["a", "b", "bound", "held"])


def _first_key(same: np.ndarray) -> np.ndarray:
    """The first index key two signatures share, from where they agree."""
    by = same.reshape(len(same), same.shape[1] // SPAN, SPAN)
    right = by.sum(2)
    chunk = (right >= SPAN - 1).argmax(1)
    wrong = ~by[np.arange(len(same)), chunk]
    return chunk * SPAN + np.where(wrong.any(1), wrong.argmax(1), 0)


def _units(members: DataFrame, labelled: DataFrame) -> DataFrame:
    """Rows of the task units: a key's classes or, for large keys, blocks of them.

    Without ``main`` (a key's largest component and its size) the blocks of a large
    key stay by themselves, dealt by another hash for each key. With it, blocks of
    the classes outside the main component meet each other and the blocks inside;
    those inside need no comparison among themselves.
    """
    large, rep = F.col("members") > BLOCK, F.col("rep")
    if "main" in members.columns:
        m = members.join(labelled, "rep")
        inside = large & (F.col("component") == F.col("main.component"))
        outer = F.when(large, F.ceil((F.col("members") - F.col("main.size")) / BLOCK)).otherwise(1)
        inner = F.when(large, F.ceil(F.col("main.size") / BLOCK)).otherwise(0)
        m = m.withColumn("block", F.when(inside, outer + F.pmod(F.xxhash64(rep), inner)).otherwise(F.pmod(F.xxhash64(rep), outer)))
        m = m.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(inside, outer).otherwise(outer + inner) - 1)))
    else:
        m = members.withColumn("block", F.pmod(F.xxhash64(rep, "key"), F.ceil(F.col("members") / BLOCK)))
        m = m.withColumn("other", F.col("block")).join(labelled, "rep")
    return m.select(
        F.when(large, F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))).otherwise(
            F.col("key")).alias("unit"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
        "key_no", "rep", "component", "n", "signature", "cells").repartition("unit").sortWithinPartitions("unit")


def confirmed(pairs: DataFrame, src: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    full = staged(shingle_sets(src.join(ids, F.col("doc_id") == F.col("id"), "left_semi")), "minhash-full")
    x, y = full.alias("x"), full.alias("y")
    both = pairs.join(x, F.col("a") == F.col("x.doc_id")).join(y, F.col("b") == F.col("y.doc_id"))
    both = both.select("a", "b", F.size(F.array_intersect("x.shingles", "y.shingles")).alias("common"),
                       (F.size("x.shingles") + F.size("y.shingles")).alias("sizes"))
    # no distinct here: it would reuse the join's partitioning by b and keep a hot partner's pairs in one task
    return both.where(100 * F.col("common") >= percent * (F.col("sizes") - F.col("common"))).select("a", "b")


def _link(src: DataFrame, classes: DataFrame, percent: int) -> DataFrame | None:
    """(id, component) of all linked classes, or None without links."""
    keys = index_keys(classes, symbols_for(percent))
    shared = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = staged(keys.join(shared, "key"), "minhash-members")
    payload = classes.select("rep", "n", "signature", "cells")
    # blocks of a large key meet from the second round on
    hot = members.where(F.col("members") > BLOCK).limit(1).count() > 0
    tested = links = comp = None
    labelled, left = payload.withColumn("component", F.col("rep")), members
    top = FIRST
    while True:
        if tested is not None:
            if comp is not None:
                labelled = payload.join(comp, F.col("rep") == F.col("id"), "left").withColumn(
                    "component", F.coalesce("component", "rep")).drop("id")
            sizes = members.join(labelled.select("rep", "component"), "rep").groupBy("key", "component").agg(
                F.count("*").alias("size"))
            open_ = sizes.groupBy("key").agg(F.max(F.struct("size", "component")).alias("main"), F.count("*").alias("parts"))
            left = members.join(open_.where("parts > 1").drop("parts"), "key")
        found = staged(proposals(_units(left, labelled), top, percent), "minhash-proposals")
        best = Window.partitionBy("a").orderBy(F.desc("bound"), "b")
        found = found.withColumn("place", F.row_number().over(best)).withColumn(
            "held", F.col("held") | (F.col("place") == top + 1))
        held = found.where("held").limit(1).count() > 0
        pairs = found.where(F.col("place") <= top).select("a", "b").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "minhash-pairs")
        new = staged(confirmed(pairs, src, percent), "minhash-links")
        tested = pairs if tested is None else tested.union(pairs)
        grown = new.limit(1).count() > 0
        links = new if links is None else links.union(new)
        if grown:
            comp = components(links)
        if not held and not hot:
            return comp
        hot = False
        top *= GROWTH


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per document: set size, component (its smallest id) and whether it is the one to keep."""
    bounded_batches(docs)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = staged(sets(src, percent=percent), "minhash-sets")
    classes = found.where("digest is not null and doc_id is not null").groupBy("digest").agg(
        F.min(F.struct("doc_id", "n_shingles", "signature", "cells")).alias("r"))
    classes = staged(classes.select("digest", F.col("r.doc_id").alias("rep"), F.col("r.n_shingles").alias("n"),
                                    F.col("r.signature").alias("signature"), F.col("r.cells").alias("cells")), "minhash-reps")
    comp = _link(src, classes, percent)
    whole = found.join(classes.select(F.col("digest").alias("d"), "rep"), F.col("digest") == F.col("d"), "left").drop("d")
    whole = whole.withColumn("rep", F.coalesce("rep", "doc_id"))
    if comp is not None:
        whole = whole.join(comp, F.col("rep") == F.col("id"), "left")
        whole = whole.withColumn("component_id", F.coalesce("component", "rep"))
    else:
        whole = whole.withColumn("component_id", F.col("rep"))
    whole = whole.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return whole.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
