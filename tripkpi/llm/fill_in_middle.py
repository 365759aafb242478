"""Fill-in-middle transformation by displacement scatter.

A text is cut into tokens (``[A-Za-z]+`` or one other code point). Two hashes
of the id choose two token boundaries, which part it into prefix, middle and
suffix; two more choose the form:

    plain   the text itself
    psm     <P>prefix<S>suffix<M>middle
    spm     <S>suffix<P>prefix<M>middle

The work is done on all bytes of an Arrow batch at once. A scan marks the
bytes where tokens start, and the cuts are selected from the marks. In the
output every byte of a part moves by one and the same displacement, so a
difference array that is non-zero only where a part starts gives, by its
cumulative sum, each byte's displacement; one numpy scatter writes the batch's
outputs. ``restore`` finds the sentinels in an output, builds the same
displacements and gathers the text back; it needs the output and the form only.

Marks take one byte per input byte; sums, displacements and positions exist
for one block of ``BLOCK`` bytes at a time, so a text of any length costs a
small multiple of its own size. There is no shuffle.

A text that holds a sentinel stays plain, so that the sentinels of the other
forms are unique. Defined cases: null and empty texts are plain with output
empty and no token; a null id hashes like an empty one; repeated rows get equal
results; an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkpi.llm.tables import bounded_batches
from tripkpi.llm.textvec import utf8

SALT = 1
PLAIN_FROM, SPM_BELOW = 90, 20
BLOCK = 1 << 20
SENTINELS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
MARK = 3
#: Parts in the order in which each form writes them; part 0 is the prefix, 1 the middle, 2 the suffix.
ORDERS = {"psm": ("P", 0, "S", 2, "M", 1), "spm": ("S", 2, "P", 0, "M", 1)}
FORMS = ("plain", "psm", "spm")
MADE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def cut_hashes(doc_id: Column, salt: int = SALT) -> list[Column]:
    """The first four 8-digit groups of the hex sha256 of ``<salt>:<doc_id>``, as integers."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


class Marks:
    """A byte mask with block-wise rank and select."""

    def __init__(self, mask: np.ndarray):
        self.mask = mask
        counts = [np.count_nonzero(mask[at:at + BLOCK]) for at in range(0, len(mask), BLOCK)]
        self.sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int64)

    def before(self, positions: np.ndarray) -> np.ndarray:
        """How many marks lie before each position."""
        block = positions // BLOCK
        out = self.sums[block]
        for b in np.unique(block[positions % BLOCK > 0]).tolist():
            here = (block == b) & (positions % BLOCK > 0)
            inside = np.cumsum(self.mask[b * BLOCK:(b + 1) * BLOCK], dtype=np.int64)
            out[here] += inside[positions[here] - b * BLOCK - 1]
        return out

    def select(self, numbers: np.ndarray) -> np.ndarray:
        """The position of each numbered mark."""
        block = np.searchsorted(self.sums, numbers, "right") - 1
        out = np.zeros(len(numbers), np.int64)
        for b in np.unique(block).tolist():
            here = block == b
            inside = np.flatnonzero(self.mask[b * BLOCK:(b + 1) * BLOCK])
            out[here] = b * BLOCK + inside[numbers[here] - self.sums[b]]
        return out


def token_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Marks the first byte of each token; rows are data[bounds[i]:bounds[i + 1]]."""
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    starts = (data & 0xC0) != 0x80
    goes_on = letter[1:] & letter[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    goes_on[inner - 1] = False
    starts[1:] &= ~goes_on
    return starts


def sentinels(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the sentinels that lie inside one row, and their rows."""
    at = np.flatnonzero(data == ord("<"))
    at = at[at + 2 < len(data)]
    at = at[(data[at + 2] == ord(">")) & np.isin(data[at + 1], [ord(k) for k in SENTINELS])]
    row = np.searchsorted(bounds, at, "right") - 1
    inside = at + MARK <= bounds[row + 1]
    return at[inside], row[inside]


def displaced(size: int, starts: np.ndarray, shifts: np.ndarray):
    """Yields (lo, hi, displacement of each byte lo to hi), from the parts' starts and shifts."""
    real = np.append(starts[1:] > starts[:-1], True) if len(starts) else np.zeros(0, bool)
    starts, shifts = starts[real], shifts[real]           # empty parts move nothing
    steps = np.diff(shifts, prepend=0)
    carry = 0
    for lo in range(0, size, BLOCK):
        hi = min(lo + BLOCK, size)
        a, b = np.searchsorted(starts, [lo, hi])
        diff = np.zeros(hi - lo, np.int64)
        diff[starts[a:b] - lo] = steps[a:b]
        diff[0] += carry
        moved = np.cumsum(diff)
        carry = int(moved[-1])
        yield lo, hi, moved


def _layout(form: np.ndarray, bounds: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Output bounds; each part's start in the output; the sentinels' starts there (-1 where plain), in order P, S, M.

    ``cut`` holds, row by row, the input bounds of the three parts: 4 columns.
    """
    lengths = np.diff(cut, axis=1)
    made = np.diff(bounds) + np.where(form > 0, 3 * MARK, 0)
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    part_at = cut[:, :3] - bounds[:-1, None] + out_bounds[:-1, None]
    mark_at = np.full((len(form), 3), -1, np.int64)
    for code, name in enumerate(FORMS[1:], 1):
        rows = np.flatnonzero(form == code)
        at = out_bounds[rows]
        for item in ORDERS[name]:
            if isinstance(item, str):
                mark_at[rows, "PSM".index(item)] = at
                at = at + MARK
            else:
                part_at[rows, item] = at
                at = at + lengths[rows, item]
    return out_bounds, part_at, mark_at


def transform(texts: pa.Array, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Token counts, forms (numbers into ``FORMS``), prefix and middle code points, outputs; ``hashes`` has 4 columns."""
    data, offsets, _ = utf8(texts)
    data, bounds = data[offsets[0]:offsets[-1]], (offsets - offsets[0]).astype(np.int64)
    tokens = Marks(token_starts(data, bounds))
    first = tokens.before(bounds)
    n = np.diff(first)
    rows = len(n)
    plain = (np.diff(bounds) == 0) | (hashes[:, 2] % 100 >= PLAIN_FROM)
    plain[sentinels(data, bounds)[1]] = True
    form = np.where(plain, 0, np.where(hashes[:, 3] % 100 < SPM_BELOW, 2, 1))
    drawn = np.sort(hashes[:, :2] % (n[:, None] + 1), axis=1)
    cut = np.empty((rows, 4), np.int64)
    cut[:, 0], cut[:, 3] = bounds[:-1], bounds[1:]
    for k in range(2):
        at_end = drawn[:, k] == n
        cut[:, k + 1] = bounds[1:]
        cut[~at_end, k + 1] = tokens.select((first[:-1] + drawn[:, k])[~at_end])
    del tokens
    cut[plain, 1:3] = bounds[1:][plain, None]            # one part: the whole text
    points = Marks((data & 0xC0) != 0x80).before(cut.ravel()).reshape(cut.shape)
    chars = np.diff(points, axis=1)
    out_bounds, part_at, mark_at = _layout(form, bounds, cut)
    out = np.empty(int(out_bounds[-1]), np.uint8)
    for lo, hi, shift in displaced(len(data), cut[:, :3].ravel(), (part_at - cut[:, :3]).ravel()):
        out[np.arange(lo, hi) + shift] = data[lo:hi]
    for k, mark in enumerate(SENTINELS.values()):
        at = mark_at[mark_at[:, k] >= 0, k]
        for j, byte in enumerate(mark):
            out[at + j] = byte
    return n, form, chars[:, 0], chars[:, 1], _strings(out, out_bounds)


def restore(outputs: pa.Array, form: np.ndarray) -> pa.Array:
    """The texts, rebuilt from outputs and forms (numbers into ``FORMS``)."""
    data, offsets, _ = utf8(outputs)
    data, bounds = data[offsets[0]:offsets[-1]], (offsets - offsets[0]).astype(np.int64)
    at, row = sentinels(data, bounds)
    at, row = at[form[row] > 0], row[form[row] > 0]
    made = np.flatnonzero(form > 0)
    if not np.array_equal(row, np.repeat(made, 3)):
        raise ValueError("an output has not one sentinel of each kind")
    at = at.reshape(-1, 3)
    size = np.diff(bounds) - np.where(form > 0, 3 * MARK, 0)
    text_bounds = np.concatenate([[0], np.cumsum(size)])
    # parts in the order of the text: where each starts in the text, and in the output
    starts = np.repeat(text_bounds[:-1, None], 3, axis=1)
    source = np.repeat(bounds[:-1, None], 3, axis=1)
    starts[:, 1:] = text_bounds[1:, None]                 # plain: the first part is all
    for code, name in enumerate(FORMS[1:], 1):
        here = form[made] == code
        rows, marks = made[here], at[here]
        lengths = np.empty((len(rows), 3), np.int64)
        for k, item in enumerate(ORDERS[name][1::2]):
            source[rows, item] = marks[:, k] + MARK
            lengths[:, item] = (marks[:, k + 1] if k < 2 else bounds[rows + 1]) - marks[:, k] - MARK
        starts[rows, 1] = starts[rows, 0] + lengths[:, 0]
        starts[rows, 2] = starts[rows, 1] + lengths[:, 1]
    text = np.empty(int(text_bounds[-1]), np.uint8)
    for lo, hi, shift in displaced(len(text), starts.ravel(), (source - starts).ravel()):
        text[lo:hi] = data[np.arange(lo, hi) + shift]
    return _strings(text, text_bounds)


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A string column over the bytes; rows of more than 2 GB together stay a large one."""
    made = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data))
    return made.cast(pa.string())


def fill_in_middle(docs: DataFrame, *, salt: int = SALT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: token count, form, the code points of prefix and middle (null if plain), the output."""
    bounded_batches(docs)
    doc_id = F.col(id_col).cast("long")
    src = docs.select(doc_id.alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      *[h.alias(f"h{k}") for k, h in enumerate(cut_hashes(doc_id, salt), 1)])

    def make(batches):
        for b in batches:
            hashes = np.column_stack([np.asarray(b.column(k)) for k in range(2, 6)]).astype(np.int64)
            n, form, prefix, middle, out = transform(b.column(1), hashes)
            names = pa.array(np.array(FORMS, object)[form], pa.string())
            cuts = [pa.array(c, pa.int64(), mask=form == 0) for c in (prefix, middle)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), names, *cuts, out],
                                             [f.split()[0] for f in MADE.split(", ")])

    return src.mapInArrow(make, MADE)


def restored(made: DataFrame) -> DataFrame:
    """Adds ``restored``, the text rebuilt from ``output`` and ``form``."""
    kinds = T.StructType([*made.schema.fields, T.StructField("restored", T.StringType())])

    def back(batches):
        for b in batches:
            names = b.column(b.schema.get_field_index("form")).to_pylist()
            form = np.array([FORMS.index(f) for f in names], np.int64)
            yield b.append_column("restored", restore(b.column(b.schema.get_field_index("output")), form))

    return made.mapInArrow(back, kinds)
