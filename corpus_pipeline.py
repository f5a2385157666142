"""The corpus pipeline: toxicity, near duplicates, decontamination, mixing, sharding.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept.
All stages but the last return the columns of ``documents`` as they came (extra ones
included); the last returns one row for each record of the mixed corpus with its shard.

* toxicity: documents that the classifier rejects (score of 0.3 or more) go;
* near duplicates: of each group the smallest id stays (five-word shingles, similarity 0.85);
* decontamination: documents that contain a window of a benchmark item go;
* mixing: every document is emitted as often as the mix takes it, so a row may be gone or
  occur up to three times;
* sharding: 24 shards by bytes through virtual slots.

Null and empty texts are not toxic, have no duplicates and no benchmark words; they stay
until the mix, which takes rows, not words, of a source by its weight.  Very long texts are judged whole.  Of
texts that are alike (ties) the smallest id stays; rows that repeat an id are judged alike and stay or go together; rows with a
null id have no duplicates.  Extra columns pass through whatever their names, in any case of letters, since helper columns take
names that the table does not have.  An empty table gives an empty corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainfeatures.llm import decontam, mixing, neardup, sharding, toxicity
from chainfeatures.llm.common import shared_table

#: SQL cannot express the first stage (a trained classifier).
ORACLE_SQL = None


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    c = _fresh(docs, "score")
    return docs.withColumn(c, toxicity.score_column(model, F.col("text").cast("string"))).filter(F.col(c) < toxicity.THRESHOLD).drop(c)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = _fresh(docs, "gone")
    gone = neardup.near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(shared_table(gone, "duplicates"), F.col("doc_id") == F.col(name), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit_copies(mixing.mix_sources(docs, keep=docs.columns))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_records(docs, shards=24)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_contaminated), ("mixing", mix), ("sharding", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
