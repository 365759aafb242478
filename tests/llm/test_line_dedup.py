import re

from tripkpi.llm import line_dedup as M

LOW = {c: c + 32 for c in range(65, 91)}


def norm(unit):
    return re.sub(r"[\x20\x09-\x0D]+", " ", unit.translate(LOW)).strip(" ")


def brute(rows, min_words=5):
    """(id, text) of distinct documents -> (lines, removed spans, text)."""
    seen, out = set(), {}

    def late(unit):
        n = norm(unit)
        if not n or len(n.split(" ")) < min_words:
            return False
        if n in seen:
            return True
        seen.add(n)
        return False

    for key in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[2])):
        i, t, _ = key
        at, spans, keep = 0, [], []
        for line in (t.split("\n") if t is not None else []):
            parts = re.findall(r"[^.!?]+[.!?]*|[.!?]+", line)
            gone = late(line)
            if gone:
                spans.append(f"{at}-{at + len(line)}")
            lo, stay = at, []
            for part in parts if len(parts) > 1 else []:
                if late(part) and not gone:
                    spans.append(f"{lo}-{lo + len(part)}")
                elif not gone:
                    stay.append(part)
                lo += len(part)
            if not gone and (len(parts) <= 1 or stay):
                keep.append("".join(stay) if len(parts) > 1 else line)
            at += len(line) + 1
        out[(i, t)] = (len(t.split("\n")) if t is not None else 0, ",".join(spans), "\n".join(keep) if t is not None else None)
    return out


def test_against_brute_force(spark, odd):
    from conftest import with_clashes
    passage = "a passage of\tmany words that repeats   here"
    more = [(200 + i, f"{passage.upper() if i % 2 else passage}\nown line number {i} with some words\n{passage}\nshort") for i in range(12)]
    df = with_clashes(odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).repartition(4))
    from pyspark.sql import functions as F
    rows = [(r.doc_id, r.text, r.k) for r in df.select("doc_id", "text", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("k")).collect()]
    want = brute(rows)
    got = M.dedup_lines(df).collect()
    assert len(got) == len(rows)
    left = [(i, t) for i, t, _ in rows]
    for r in got:
        options = [want[x] for x in left if x[0] == r.doc_id]
        assert (r.n_units, r.removed_spans, r.text) in options, r
        assert r.n_removed == (len(r.removed_spans.split(",")) if r.removed_spans else 0)
    assert M.dedup_lines(df.limit(0)).count() == 0


def test_paragraphs_and_min_words(spark):
    df = spark.createDataFrame([(1, "one two\nthree four five\n\nother words are here now"), (2, "x\n\nOne two\nthree  four five")], "doc_id long, text string")
    got = {r.doc_id: r for r in M.dedup_lines(df, separator="\n\n").collect()}
    assert got[2].text == "x" and got[2].removed_spans == "3-27" and got[1].n_removed == 0
    assert {r.n_removed for r in M.dedup_lines(df, min_words=9).collect()} == {0}


def test_passages_inside_lines(spark):
    passage = "One sentence of many words here. Another one follows it with words! And is this the third of them?"
    rows = [(1, "Start of its own first line. " + passage + " The end of it all is here."), (2, passage), (3, "Short. " + passage + " Own words at the very end."),
            (4, "x.\n" + passage.upper() + "\ny."), (5, "No. Repeats. Here are none of them at all."), (6, "...!? . ?")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in M.dedup_lines(df).collect()}
    want = brute([(i, t, 0) for i, t in rows])
    for i, t in rows:
        assert (got[i].n_units, got[i].removed_spans, got[i].text) == want[(i, t)], i
    assert got[1].n_removed == 0 and got[2].text == "" and got[3].text == "Short. Own words at the very end." and got[4].text == "x.\ny."
    assert got[5].text == rows[4][1] and got[6].text == rows[5][1]
