"""Substring dedup by lines and sentences: normalise, group digests globally, keep the earliest occurrence.

A unit is a line (or a paragraph, with ``separator`` set to an empty line), and
in a line of several sentences each sentence too: a run up to and including the
next of ``. ! ?``, so that a passage that repeats inside longer lines is met. For
comparison A-Z is lower-cased and each run of white space becomes one space;
units of fewer than ``min_words`` words are never removed. Of all units with
the same 128-bit digest the earliest in rank (document id, then position)
stays, the rest go, and the spans of what went are kept as code point offsets
into the original text. A line that goes takes its separator along, and so does
one of which all sentences went. A removed line's sentences aren't listed; they
are never the earliest, as the line's first occurrence holds them too.

Digests are counted with map-side combining and only repeated ones are joined
back, so a unit that millions of documents share costs one row per task; the
join's hot keys are left to adaptive skew splitting. Texts are read twice and
shuffled only with their own spans.

Defined cases: null text stays null with 0 units; empty text has one empty
unit; null ids rank last; rows that share an id are told apart by their text,
rows equal in both are one document and get the same result; an empty table
gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.llm.tables import bounded_batches, staged

MIN_WORDS = 5
SENTENCE = re.compile(r"[^.!?]+[.!?]*|[.!?]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
LAST_ID = (1 << 63) - 1


def _norm(unit: str) -> str:
    return SPACE.sub(" ", unit.translate(LOWER)).strip(" ")


def split_units(text: str, separator: str = "\n") -> list[tuple[int, int, int, int, str]]:
    """(line, sentence, start, end, normalised) of each unit, offsets in code points; sentence -1 is the whole line."""
    out, at = [], 0
    for no, line in enumerate(text.split(separator)):
        out.append((no, -1, at, at + len(line), _norm(line)))
        parts = SENTENCE.findall(line)
        if len(parts) > 1:
            lo = at
            for k, part in enumerate(parts):
                out.append((no, k, lo, lo + len(part), _norm(part)))
                lo += len(part)
        at += len(line) + len(separator)
    return out


def units(docs: DataFrame, min_words: int = MIN_WORDS, separator: str = "\n") -> DataFrame:
    """One row per unit long enough to be removed: document, position, span, digest."""
    def cut(batches):
        for b in batches:
            rows = []
            for doc, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                for no, part, lo, hi, norm in split_units(text, separator):
                    if norm.count(" ") + 1 >= min_words and norm:
                        rows.append((doc, key, no, part, lo, hi, hashlib.md5(norm.encode(), usedforsecurity=False).digest()))
                if len(rows) > 50_000:
                    yield _rows(rows)
                    rows = []
            yield _rows(rows)

    return docs.where("text is not null").select("rank_id", "text_key", "text").mapInArrow(cut, UNITS)


UNITS = "rank_id long, text_key long, unit_no int, part_no int, lo int, hi int, digest binary"
RANK = ("rank_id", "text_key", "unit_no", "part_no")


def _rows(rows: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    cols = list(zip(*rows)) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                      [f.split()[0] for f in UNITS.split(", ")])


def without(text: str, gone: list, separator: str) -> tuple[int, list[tuple[int, int]], str]:
    """Lines, removed spans and what is left of a text, from its removed units (unit_no, part_no, lo, hi), in order."""
    lines = text.split(separator)
    if not gone:
        return len(lines), [], text
    whole = {g["unit_no"] for g in gone if g["part_no"] < 0}
    parts: dict[int, list[int]] = {}
    spans = []
    for g in gone:
        if g["part_no"] < 0 or g["unit_no"] not in whole:
            spans.append((g["lo"], g["hi"]))
            if g["part_no"] >= 0:
                parts.setdefault(g["unit_no"], []).append(g["part_no"])
    left = []
    for no, line in enumerate(lines):
        if no in whole:
            continue
        if no in parts:
            out = set(parts[no])
            stay = [p for k, p in enumerate(SENTENCE.findall(line)) if k not in out]
            if not stay:
                continue
            line = "".join(stay)
        left.append(line)
    return len(lines), spans, separator.join(left)


def dedup_lines(docs: DataFrame, *, min_words: int = MIN_WORDS, separator: str = "\n", id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: its lines, how many units went, their spans, and the text without them."""
    bounded_batches(docs)
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("rank_id"),
                      F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_key"), text.alias("text"))
    found = staged(units(src, min_words, separator), "lines")
    # repeated rows are one document: distinct units, which map-side combining makes cheap
    first = found.groupBy("digest").agg(F.min(F.struct(*RANK)).alias("first"), F.max(F.struct(*RANK)).alias("last"))
    # staged, so that the join's sides are plain exchanges, of which Spark can split a hot line's partition
    repeated = staged(first.where(F.col("first") != F.col("last")).select("digest", "first"), "repeated-lines")
    later = found.join(repeated, "digest").where(F.struct(*RANK) != F.col("first"))
    spans = later.groupBy("rank_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("unit_no", "part_no", "lo", "hi"))).alias("gone"))
    both = src.join(spans, ["rank_id", "text_key"], "left").select("doc_id", "text", "gone")

    def keep(batches):
        for b in batches:
            out = []
            for doc, body, gone in zip(*[b.column(i).to_pylist() for i in range(3)]):
                lines, spans, left = without(body, gone or [], separator) if body is not None else (0, [], None)
                out.append((doc, lines, len(spans), ",".join(f"{lo}-{hi}" for lo, hi in spans), left))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in
                 enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                ["doc_id", "n_units", "n_removed", "removed_spans", "text"])

    return both.mapInArrow(keep, "doc_id long, n_units long, n_removed long, removed_spans string, text string")
