import numpy as np

from tripkpi.llm import byte_convnet as M


def test_learns_by_gradient_and_scores_spans_alike():
    rng = np.random.default_rng(0)
    good = [rng.choice(np.frombuffer(b"abcde ", np.uint8), rng.integers(20, 900)) for _ in range(80)]
    bad = [np.concatenate([t[:len(t) // 2], np.frombuffer(b"!?!?!?", np.uint8), t[len(t) // 2:]]) for t in good[:40]]
    net = M.ConvNet(8, 4).fit(good + bad, np.array([1] * 80 + [0] * 40, np.float32), steps=150)
    s = net.scores(good + bad)
    assert ((s >= 0.5) == np.array([True] * 80 + [False] * 40)).mean() > 0.95
    for t in (good[0], bad[1], np.concatenate(good), np.zeros(0, np.uint8), good[2][:1]):
        whole = net.scores([t])[0]
        if len(t) > 2 * M.BLOCK:
            for span in (2 * M.BLOCK, 1024):
                assert abs(M._long_score(net, t, span) - whole) < 1e-5
    assert np.allclose(net.scores(good[:7]), [net.scores([t])[0] for t in good[:7]])


def test_gradient_matches_differences():
    """One step's table gradient, read off Adam's first moment, against finite differences of the loss."""
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 103, 90).astype(np.uint8) for _ in range(4)]
    y = np.array([1, 0, 1, 0], np.float32)
    net = M.ConvNet(3, 3, seed=2)

    def loss():
        s = net.freeze().scores(texts)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    eps, before = 1e-3, {k: v.copy() for k, v in net.p.items()}
    slope = {}
    for at in [(0, 98, 1), (1, 100, 0), (2, 101, 2)]:
        for sign in (1, -1):
            net.p["table"][at] = before["table"][at] + sign * eps
            slope[at] = slope.get(at, 0) + sign * loss() / (2 * eps)
            net.p["table"][at] = before["table"][at]
    step = M.ConvNet(3, 3, seed=2).fit(texts, y, steps=1, batch=4, rate=1e-6, decay=0)
    for at, g in slope.items():
        moved = step.p["table"][at] - before["table"][at]
        assert abs(g) < 1e-4 or np.sign(moved) == -np.sign(g)


def test_odd_documents(spark, odd):
    from conftest import with_clashes
    labels = with_clashes(spark.createDataFrame(
        [(i, i % 2, 0) for i in range(13)] + [(None, 1, 0), (3, None, 0), (4, 1, 1), (999, 1, 0)], "doc_id long, quality int, toxic int"))
    got = M.quality(odd, labels).toPandas()
    assert len(got) == odd.count() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all() and got.held_out[got.doc_id.isna()].all()
    assert M.quality(odd.limit(0), labels).count() == 0
    assert set(M.quality(odd, labels.limit(0)).toPandas().score) == {0.5}
    kept = M.keep_good(odd, odd, labels)
    assert kept.columns == odd.columns and kept.count() == got.predicted.sum()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = M.quality(docs, labels).where("held_out").join(labels, "doc_id").toPandas()
    assert (got.predicted == got.quality).mean() > 0.93
    assert (got.score[got.quality == 1].median()) > (got.score[got.quality == 0].max())


def plain_score(net, text):
    """The score by its definition, in loops: responses, maxima of two neighbouring blocks, mean and maximum, logistic law."""
    import math
    data = list(text) or [0]
    table, width = net.p["table"], net.width
    padded = data + [0] * (width - 1)
    resp = [[sum(float(table[j][padded[i + j]][f]) for j in range(width)) for f in range(net.filters)] for i in range(len(data))]
    blocks = [resp[k:k + M.BLOCK] for k in range(0, len(data), M.BLOCK)]
    chunks = [a + b for a, b in zip(blocks, blocks[1:])] or blocks
    pooled = [[max(0.0, max(r[f] for r in c)) for f in range(net.filters)] for c in chunks]
    z = float(net.p["bias"][0])
    for f in range(net.filters):
        column = [p[f] for p in pooled]
        z += sum(column) / len(column) * float(net.p["mean"][f]) + max(column) * float(net.p["top"][f])
    return 1 / (1 + math.exp(-z))


def test_scores_against_plain_loops():
    rng = np.random.default_rng(3)
    net = M.ConvNet(5, 6, seed=4)
    texts = [rng.integers(0, 256, n).astype(np.uint8) for n in (0, 1, 3, 127, 128, 129, 256, 300, 700)]
    got = net.scores(texts)
    for t, g in zip(texts, got):
        assert abs(plain_score(net, t.tolist()) - g) < 1e-5


def test_query_against_plain_loops(spark, docs, sf_small):
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    net = M.fit(docs, labels)
    want = {r.doc_id: r.score for r in M.quality(docs, labels).collect()}
    for r in docs.where("doc_id % 40 = 3").select("doc_id", "text").collect():
        if len(r.text or "") < 3000:
            assert abs(plain_score(net, list((r.text or "").encode())) - want[r.doc_id]) < 1e-4
