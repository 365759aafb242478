import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripkpi.llm import source_mix as M


def test_permutation_and_inverse():
    for n in (1, 2, 3, 17, 1000):
        for turn in (0, 1):
            p = M.permute(np.arange(n), n, 5, turn)
            assert sorted(p) == list(range(n))
            assert (M.permute(p, n, 5, turn, inverse=True) == np.arange(n)).all()


def test_targets_share_the_excess_again():
    goal = M.targets([100, 100, 1000], [5, 2, 1])
    assert goal[0] == 200 and goal[1] == 200 and goal[2] == pytest.approx(1400)
    assert M.targets([0, 10], [5, 2]) == [0, 15] and M.targets([], []) == [] and M.targets([0, 0], [5, 2]) == [0, 0]
    small = M.targets([1000, 10, 1000], [5, 2, 1])
    assert sum(small) == pytest.approx(1.5 * 2010) and all(g <= 2 * s for g, s in zip(small, [1000, 10, 1000]))


def test_planned_slots_reach_the_target_exactly():
    rng = np.random.default_rng(0)
    for rank in range(200):
        size = int(rng.integers(1, 2000))
        target = float(rng.random() * 2 * size)
        s = M.plan_source("s", rank, 1, size, target, 64, 1)
        lengths = [64 if b != s.blocks - 1 else size - (s.blocks - 1) * 64
                   for t in (0, 1) for b in M.permute(np.arange(s.blocks), s.blocks, rank, t, 1)]
        total = sum(lengths[:s.slots])
        assert s.words == round(target) and total >= s.words and (not s.slots or total - lengths[s.slots - 1] < s.words)


def test_shard_counts_keep_the_totals():
    counts = M.shard_counts([10, 0, 1000, 3], 7, 3)
    assert counts.sum(0).tolist() == [10, 0, 1000, 3] and counts.sum(1).max() - counts.sum(1).min() <= 1
    assert M.shard_counts([], 3, 1).sum() == 0


def test_rows_of_odd_documents(spark, odd):
    rows = M.mix(odd).toPandas()
    assert len(rows) == odd.count()
    src = odd.select("doc_id", "source", "text").toPandas()
    src["size"] = [len(re.findall(M.WORD, t)) if t is not None else 0 for t in src.text]
    assert sorted(rows["size"]) == sorted(src["size"])
    total = src.groupby(src.source.fillna("~null"))["size"].sum()
    names = sorted(total.index, key=lambda s: (s == "~null", s))
    goal = M.targets([int(total[n]) for n in names], [(5.0, 2.0, 1.0)[i % 3] for i in range(len(names))])
    assert sorted(set(zip(rows.source_size, rows.target.round(6)))) == sorted({(int(total[n]), round(g, 6)) for n, g in zip(names, goal)})
    assert (rows.taken <= 2 * rows["size"]).all()
    assert rows.taken.sum() == sum(round(g) for g in goal)
    again = M.mix(odd.repartition(5)).toPandas()
    order = ["doc_id", "size", "source_size", "taken"]
    assert rows.sort_values(order)[order].reset_index(drop=True).equals(again.sort_values(order)[order].reset_index(drop=True))
    # the mix as documents holds the words that mix() counts
    mixed = M.mixed_documents(odd)
    assert mixed.columns == odd.columns
    got = sum(len(re.findall(M.WORD, r.text)) for r in mixed.select("text").collect())
    assert got == rows.taken.sum()


def test_empty_table(odd):
    assert M.mix(odd.limit(0)).count() == 0 and M.mixed_documents(odd.limit(0)).count() == 0


def test_draws_beyond_numpys_range_keep_their_law():
    rng = np.random.default_rng(0)
    good, bad, draws = 3_000_000_000, 9_000_000_000, 40_000
    got = np.array([M._hypergeometric(rng, good, bad, draws) for _ in range(400)])
    mean, sd = draws * good / (good + bad), (draws * 0.25 * 0.75) ** 0.5
    assert abs(got.mean() - mean) < 4 * sd / 20 and 0.85 < got.std() / sd < 1.15
    counts = M.shard_counts([2_000_000_000, 500_000_000, 7], 5, 3)
    assert counts.sum(0).tolist() == [2_000_000_000, 500_000_000, 7] and np.ptp(counts.sum(1)) <= 1


def test_null_and_repeated_ids_spread_over_sub_streams(spark):
    rows = [(None if i % 2 else 5, f"text {i} of some words", "s") for i in range(2000)]
    sizes = M.sized(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    per_part = [r["count"] for r in sizes.withColumn("docs", F.lit(2000)).groupBy(M.sub_stream().alias("part")).count().collect()]
    assert len(per_part) > 30 and max(per_part) < 150


def test_slots_come_from_many_tasks(spark, docs):
    sources = M.plan_sources(M.sized(docs))
    drawn = M.draws(spark, sources)
    assert drawn.select(F.spark_partition_id()).distinct().count() > 1
