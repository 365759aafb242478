import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripkpi.llm import fill_in_middle as M


def hashes(doc_id):
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(d[8 * k:8 * k + 8], 16) for k in range(4)]


def brute(doc_id, text):
    text = text or ""
    words = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(words), hashes(doc_id)
    a, b = sorted(x % (n + 1) for x in h[:2])
    pre, mid, suf = "".join(words[:a]), "".join(words[a:b]), "".join(words[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("block", [5, 64, 1 << 20])
def test_batches_against_brute_force(monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(40):
        rows = [(rng.randrange(1 << 40), None if rng.random() < 0.1 else
                 "".join(rng.choice("ab Z<P>SM\n9\x00é中\U0001f600") for _ in range(rng.choice([0, 1, 2, 6, 50]))))
                for _ in range(rng.choice([0, 1, 30]))]
        drawn = np.array([hashes(i) for i, _ in rows], np.int64).reshape(-1, 4)
        n, form, prefix, middle, out = M.transform(pa.array([t for _, t in rows], pa.string()), drawn)
        back = M.restore(out, form).to_pylist()
        for k, (i, t) in enumerate(rows):
            cut = (None, None) if form[k] == 0 else (prefix[k], middle[k])
            assert (n[k], M.FORMS[form[k]], *cut, out[k].as_py()) == brute(i, t)
            assert back[k] == (t or "")


def test_odd_documents(spark, odd):
    made = M.restored(M.fill_in_middle(odd))
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    got = sorted(map(repr, (tuple(r) for r in made.collect())))
    want = sorted(repr((r.doc_id, *brute(r.doc_id, r.text), r.text or "")) for r in odd.collect())
    assert got == want
    assert M.restored(M.fill_in_middle(odd.limit(0))).count() == 0


def test_forms_and_sentinels(spark, docs):
    forms = {r["form"]: r["count"] for r in M.fill_in_middle(docs).groupBy("form").count().collect()}
    assert set(forms) == set(M.FORMS)
    marked = docs.select("doc_id", F.concat("text", F.lit(" <M> ")).alias("text"))
    assert {r.form for r in M.fill_in_middle(marked).select("form").distinct().collect()} == {"plain"}
    # half a sentinel at the seams is text
    seams = spark.createDataFrame([(i, "<P" * 3 + ">" * (i % 2) + "S>M><<") for i in range(200)], "doc_id long, text string")
    for r in M.restored(M.fill_in_middle(seams)).collect():
        assert r.restored == "<P" * 3 + ">" * (r.doc_id % 2) + "S>M><<"


def test_other_salt_and_columns(spark, odd):
    other = odd.select(F.col("doc_id").alias("key"), F.col("text").alias("body"))
    a = M.fill_in_middle(other, id_col="key", text_col="body", salt=2)
    assert M.restored(a).where("restored is null").count() == 0 and a.count() == odd.count()


def test_an_output_without_its_sentinels_is_refused():
    with pytest.raises(ValueError):
        M.restore(pa.array(["<P>a<S>b"]), np.array([1]))
