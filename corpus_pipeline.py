"""The corpus pipeline over ``documents``: five stages, each written as Parquet and reread as the next one's input.

Every stage works on all rows its predecessor kept and applies its decisions;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi.llm import byte_convnet, decontaminate, minhash_hamming, source_mix, splitter_shards
from tripkpi.llm.tables import staged, table

#: Least similarity of near duplicates, in percent of their five-word shingles; 85 is the contract of op1 alone.
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network scores below its threshold go; it learns from the labelled rows not held out."""
    return byte_convnet.keep_good(docs, docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (similarity ``NEAR_PERCENT``) stays, the one with the smallest id.

    Rows equal in id and text count as one document (of rows that differ in other
    columns, the first by these as JSON), other texts under the same id as
    documents of their own (of those in one group that with the smallest sha256
    stays). Documents without words are no near duplicates of anything, and
    those without an id aren't judged: they stay.
    """
    named = docs.where("doc_id is not null")
    rows, ids = named.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if rows == ids:
        kept = minhash_hamming.near_duplicates(named, percent=NEAR_PERCENT).where("kept").select(F.col("doc_id").alias("kept_id"))
        stay = named.join(kept, named["doc_id"] == kept["kept_id"], "left_semi")
    else:
        others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")])
        # of rows equal in id and text the one whose other columns come first as JSON, whatever the partitioning
        once = named.groupBy("doc_id", "text").agg(F.min_by(others, F.to_json(others)).alias("near_rest")).select(
            *[F.col(f"near_rest.`{c}`") if c not in ("doc_id", "text") else F.col(c) for c in docs.columns])
        # numbers instead of a hash, which two documents could share; written once, so that all reads see the same ones
        once = staged(once.withColumn("near_uid", F.monotonically_increasing_id()), "pipeline-near-uid")
        found = minhash_hamming.near_duplicates(once, id_col="near_uid", percent=NEAR_PERCENT).select(
            F.col("doc_id").alias("kept_uid"), "component_id")
        owner = once.select("near_uid", F.struct("doc_id", F.sha2("text", 256)).alias("owner"))
        kept = found.join(owner, found["kept_uid"] == owner["near_uid"]).groupBy("component_id").agg(
            F.min_by("kept_uid", "owner").alias("kept_uid")).select("kept_uid")
        stay = once.join(kept, once["near_uid"] == kept["kept_uid"], "left_semi").drop("near_uid")
    return stay.unionByName(docs.where("doc_id is null"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; a document that is nothing else goes."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document once per pass that drew from it, its text the words drawn; undrawn documents go."""
    return source_mix.mixed_documents(docs)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and slot."""
    return splitter_shards.shard(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontaminate_stage),
    ("source_mix", mix_stage),
    ("sharding", shard_stage),
]

#: A learned network and hashed draws have no SQL form: the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
