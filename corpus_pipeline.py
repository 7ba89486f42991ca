"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

Every stage but the last returns the columns of its input.  A row is known by
its doc_id and the hash of its text, so rows that share a doc_id are judged by
their own texts.  SQL cannot express the trained classifier and the iterative
fit, so there is no oracle SQL; the tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.llm import decontaminate, jaccard_join, mixing, ring, toxicity
from civicspark.llm.langid import fold
from civicspark.llm.store import free_name, written

QUALITY_SHARES = {"high": 0.88, "low": 0.12}         # shares of tokens in the mixture


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of doc_id and text, and that column's name, which no other column has."""
    key = free_name("_row_key", docs.columns)
    return docs.withColumn(key, F.xxhash64("doc_id", "text", F.lit("row"))), key


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score below 0.5).

    Null and empty texts are judged as texts without words; repeated rows all go or stay; without
    labels, and for an empty table, all rows stay."""
    learn, score = fold(F.col("doc_id"), 5) != 0, free_name("_toxicity", docs.columns)
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), learn)
    return toxicity.score(docs, model, docs.columns, score).filter(F.col(score) < 0.5).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest doc_id; rows equal in
    doc_id and text are one.

    Null and empty texts are linked with nothing and stay; a row without doc_id stays only if its
    component has no other; an empty table stays empty."""
    keyed, key = _keyed(docs)
    found = jaccard_join.link_components(keyed.select(F.col(key).alias("doc_id"), "text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key))[key].alias(key)
    names = keyed.select(key, "doc_id")
    kept = (found.select(F.col("doc_id").alias(key), "component_id").distinct().join(names.distinct(), key)
            .groupBy("component_id").agg(first).select(key))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.

    Null and empty texts hold none; repeated rows all go or stay; an empty table stays empty."""
    keyed, key = _keyed(docs)
    hit = decontaminate.contaminated(keyed.select(key, "text"), _table(spark, sf_dir, "benchmark"), [key])
    return keyed.join(hit.select(key).distinct(), key, "left_anti").select(*docs.columns)


def mix_to_shares(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents by their fitted rates, none of which is below 1: none has to go.

    A text without words has the rate of its posterior; repeated rows have the same number of copies;
    without labels every rate is 1; an empty table stays empty."""
    keyed, key = _keyed(docs)
    domain = F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    rates = mixing.mix(keyed.select("doc_id", key, "text"), _table(spark, sf_dir, "labels"), domain, QUALITY_SHARES,
                       ["doc_id", key], keep_all=True)
    copies, nth = free_name("_copies", docs.columns), free_name("_copy", docs.columns)
    times = rates.select(key, F.col("copies").alias(copies)).dropDuplicates([key])
    return keyed.join(times, key).withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row, whatever its text; the columns of ``op10``."""
    return ring.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_to_shares),
    ("sharding", shard),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
