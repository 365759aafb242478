import numpy as np

from tripkpi.llm import kmeans_tree_ann as M


def brute(rows, k=20, every=20):
    out = {}
    for q, v in rows:
        if q % every == 0:
            near = sorted((-float(np.dot(v, x)), i) for i, x in rows if i != q)[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def test_hot_copies_bad_rows_and_ties(spark):
    from conftest import with_clashes
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 8)]) for i in range(300)] + [(300 + i, [1.0] * 8) for i in range(200)]
    odd = [(600, None), (601, []), (602, [0.0] * 8), (603, [1.0, None] + [0.0] * 6), (604, [float("nan")] * 8),
           (605, [1.0] * 7), (None, [1.0] * 8), (620, [float("inf")] + [1.0] * 7)]
    df = with_clashes(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(4))
    got = M.search(df, target=1.0).toPandas()
    want = brute([(i, np.array(v)) for i, v in rows if any(v)])
    assert set(got.query_id) == set(want)
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert list(g["rank"]) == list(range(1, 21))
        assert np.allclose(g.score, [s for _, s in want[q]])
        if q >= 300:
            assert list(g.vec_id) == [i for i, _ in want[q]]


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in M.search(df).orderBy("rank").collect()] == [(0, 1, 1, 4.0), (0, 2, 2, -1.0)]
    assert M.search(df.limit(0)).count() == 0
    assert M.search(df.where("vec_id = 0")).count() == 0


def test_recall_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = M.search(df).toPandas()
    pdf = df.toPandas()
    ids, x = pdf.vec_id.to_numpy(), np.array(pdf.embedding.tolist(), np.float64)
    hit = total = 0
    for q, g in got.groupby("query_id"):
        s = x @ x[np.flatnonzero(ids == q)[0]]
        near = [ids[i] for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        hit, total = hit + len(set(near) & set(g.vec_id)), total + 20
        at = dict(zip(ids, s))
        assert max(abs(at[v] - y) for v, y in zip(g.vec_id, g.score)) < 1e-12
    assert total == 20 * (ids % 20 == 0).sum() and hit / total >= 0.9


def test_best_bin_first_visits_every_leaf_once():
    x = np.random.default_rng(0).normal(size=(2000, 6))
    tree = M.Tree(x, branch=4, leaf=50)
    for v in tree.visit(x[:5], tree.leaves):
        assert sorted(v) == list(range(tree.leaves))
    assert tree.visit(x[:2], 3) == [v[:3] for v in tree.visit(x[:2], tree.leaves)]
    assert M._pack({0: 10, 1: 10, 2: 100, 3: 5}, 25) == {0: (0, 1), 1: (0, 1), 2: (1, 4), 3: (5, 1)}
