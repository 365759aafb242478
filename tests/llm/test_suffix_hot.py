"""A passage that all documents hold: its bucket gets each byte string once per slice, not once per document."""

import numpy as np
import pyarrow as pa

from tripkpi.llm import suffix_dedup as S


def test_common_strings_are_sent_once_per_slice():
    rng = np.random.default_rng(7)
    text = rng.integers(97, 123, 400).astype(np.uint8)
    _, lo, count, _ = S.anchors(text, np.array([0, len(text)]))
    docs = 300
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(docs), pa.int64()), pa.array(range(docs), pa.int64()), pa.array([text.tobytes()] * docs, pa.binary()),
         pa.array([lo.tolist()] * docs, pa.list_(pa.int32()))], ["uid", "rank", "raw", "los"])
    rows = [r for b in S._windows(64)(iter([batch])) for r in b.to_pylist()]
    assert sum(len(r["los"]) // 4 for r in rows if r["bytes"]) == len(lo)
    rows.sort(key=lambda r: r["part"])
    sent = pa.RecordBatch.from_pylist(rows)
    got = sorted((u, p, m) for b in S._covered(iter([sent])) for u, p, m in zip(*(c.to_pylist() for c in b.columns)))
    assert got == sorted((u, int(p), (1 << int(n)) - 1) for u in range(1, docs) for p, n in zip(lo, count))


def test_packets_of_slices_that_begin_alike_spread():
    assert len({S._anywhere(np.int64(u), 0, 64) for u in range(1000)}) == 64
    assert [S._anywhere(np.int64(-5), n, 7) for n in range(7)] != [S._anywhere(np.int64(-5), 0, 7)] * 7
