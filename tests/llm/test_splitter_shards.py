import zlib

from tripkpi.llm import splitter_shards as M


def check(df, shards=40):
    rows = M.shard(df, shards=shards).toPandas()
    assert len(rows) == df.count() and set(rows["law"]) <= {"bytes"} and rows["shard"].between(0, shards - 1).all()
    for _, part in rows.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    return rows


def test_odd_documents(odd):
    rows = check(odd)
    want = sorted((len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in odd.select("text").collect())
    assert sorted(zip(rows["size"], rows["text_crc32"])) == want


def test_sizes_are_near_equal_and_a_hot_group_is_split(spark):
    rows = [(i, f"text number {i * 7919 % 100003} " * (1 + i % 9)) for i in range(4000)] + [(10_000 + i, "hot copy " * 8) for i in range(2000)]
    out = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    load = out.groupby("shard")["size"].sum()
    assert len(load) == 40 and load.max() <= 1.02 * load.mean() and load.min() >= 0.98 * load.mean()
    spread = out.groupby("text_crc32")["shard"].nunique()
    assert (spread > 1).sum() == 1                       # only the hot group is in several shards


def test_empty_table_and_few_rows(spark, odd):
    assert M.shard(odd.limit(0)).count() == 0
    check(odd.limit(2))


def test_reruns_agree(odd):
    a, b = (M.shard(d).select("doc_id", "size", "shard").toPandas().sort_values(["doc_id", "size", "shard"]).reset_index(drop=True)
            for d in (odd, odd.repartition(6)))
    assert a.equals(b)


def test_deal_prefers_the_lightest():
    plan = {no: s for no, s, _ in M.deal([(1, 10, 1), (2, 10, 1), (3, 5, 1), (4, 5, 1), (5, 10, 1)], 2)}
    load = [0, 0]
    for no, size in ((1, 10), (2, 10), (3, 5), (4, 5), (5, 10)):
        load[plan[no]] += size
    assert load == [20, 20]


def test_equal_rows_at_a_third_of_the_table_are_split(spark):
    rows = [(None, "the very same row " * 9)] * 3000 + [(i, f"text number {i * 7919 % 100003} " * (1 + i % 9)) for i in range(6000)]
    out = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    load = out.groupby("shard")["size"].sum()
    assert len(load) == 40 and load.max() <= 1.02 * load.mean() and load.min() >= 0.98 * load.mean()
