"""The corpus pipeline: five stages over ``documents``, each with one operator of ``spanloom.llm``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; all but the last return the columns of documents. The
caller writes a stage's result and hands the reread table to the next one, so
a stage removes the scratch tables of the stages before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import decontaminate, language_id, mixing, ngram_join, sharding
from spanloom.llm.common import Scratch, owned, spare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The language stage rejects texts without letters, and those of which no language has half the probability.
LEAST_SCORE = 0.5
OWNER = "pipeline"


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with at least LEAST_SCORE; null, empty and letterless texts go."""
    own = spare(docs, "language")
    with owned(spark, OWNER, docs):
        out = language_id.identify(docs, name=own)
    return out.filter((F.col(own)["lang_pred"] != language_id.UNKNOWN) & (F.col(own)["score"] >= LEAST_SCORE)).drop(own)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts that share 80 % of their five-word shingles."""
    with owned(spark, OWNER, docs):
        return ngram_join.drop_similar(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    with owned(spark, OWNER, docs):
        return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the raked weights of source, language and topic."""
    with owned(spark, OWNER, docs):
        own = spare(docs, "mix")
        return mixing.mix(docs, name=own).filter(F.col(own)["kept"]).drop(own)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document left."""
    with owned(spark, OWNER, docs):
        return sharding.shard_digest(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_languages),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("mixing", sample_mixture),
    ("sharding", deal_shards),
]

#: Training, signatures and alignment are beyond SQL; the tests hold the stages against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
