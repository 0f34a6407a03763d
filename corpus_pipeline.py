"""Training corpus pipeline: toxic texts go, one text of each near-copy group stays, benchmark passages go, sources are mixed, shards are dealt.

Each stage takes the rows that the one before it kept and wrote, and returns the columns of documents; the last one adds the shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftplan.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from liftplan.llm.shared import prepare, table
from liftplan.session import scratch_path, stage, staging

SHARDS = 8

#: Scores and set similarities have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model does not reject.

    A null or empty text is scored like any other and stays unless it is scored toxic; repeated rows are judged alike; an empty table gives an empty result.
    """
    model = toxicity.fit(docs, table(prepare(spark), sf_dir, "labels"))
    return docs.where(toxicity.toxicity_score(F.col("text"), model) < 0.5)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts linked by shingle similarity: the one with the smallest id.

    Rows without words all stay; of repeated rows, and of equal ids with different texts in one group, one stays. An empty table gives an empty result.
    """
    prepare(spark)
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item.

    Null and empty texts contain none and stay; repeated rows are judged alike; an empty table, or an empty benchmark, takes nothing away.
    """
    return decontaminate.without_items(docs, table(prepare(spark), sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them.

    Null and empty texts have no words and only whole copies; null sources are one source, the last; equal ids and texts are taken alike; an empty table gives an empty result.
    """
    prepare(spark)
    return mixing.take_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with their virtual slot and shard.

    Null text counts as empty, a null id goes by its text, equal ids share a slot; columns with these two names are replaced. An empty table gives an empty result.
    """
    return sharding.with_shards(docs, scratch_path(prepare(spark), "slot-map"), SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read again by the next.

    The result is written too, so that everything staged on the way is dropped at the end.
    """
    docs = table(prepare(spark), sf_dir, "documents")
    path = scratch_path(spark, "pipeline-result")
    with staging(spark):
        for i, (name, function) in enumerate(STAGES):
            docs = function(spark, docs, sf_dir)
            if i + 1 < len(STAGES):
                docs = stage(docs, f"pipeline-{name}")
        docs.write.parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline as a registered query."""
    return run(spark, sf_dir)
