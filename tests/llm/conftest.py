"""Odd documents shared by the operators' tests."""

import random

import pytest
from pyspark.sql import functions as F

#: Names that the operators use inside; the tables of the tests have such columns of their own.
CLASHING = ["size", "rank", "rep", "component", "component_id", "score", "uid", "part", "key", "id", "digest", "unit",
            "target", "taken", "shard", "slot", "kept", "raw", "lo", "hi", "tie", "start", "n", "range_no", "k1", "gone",
            "leaf", "vector", "host", "path", "rid", "fit_id", "rank_id", "text_key", "mix_id", "letters", "held_out"]


def odd_rows():
    rng = random.Random(4)
    words = ["w%d" % i for i in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    near = base[0].split()
    near[60] = "changed"
    rows += [(10, base[0]), (11, " ".join(near)), (12, base[1].upper()), (13, base[2] + "\n" + base[3]),
             (14, None), (15, ""), (16, " \t\n "), (17, "one"), (18, "two words"), (19, "über 中文 \U0001f600 naïve café"),
             (20, "x" * 70_000), (21, "long " * 40_000 + base[4]), (22, "\x00 nul \x1f bytes"), (None, base[5]), (None, None),
             (23, base[5]), (23, base[5]), (24, "same id, one text"), (24, "same id, another text of its own")]
    return rows


def with_clashes(df):
    for c in CLASHING:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def odd(spark):
    """doc_id, text, lang, source, n_chars, and columns with clashing names; nulls, ties, repeats, long texts."""
    rows = [(i, t, None if k % 5 == 0 else ("aa", "bb")[k % 2], None if k % 7 == 0 else f"s{k % 3}", None if t is None else len(t))
            for k, (i, t) in enumerate(odd_rows())]
    return with_clashes(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
                        .repartition(3)).cache()


@pytest.fixture(scope="session")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")
