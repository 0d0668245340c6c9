"""From raw documents to token ids: filters, near-duplicates, mixing and encoding, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourwatt.llm.bagminhash import one_per_class
from hourwatt.llm.common import fresh, handed_over, table
from hourwatt.llm.mixing import mix_by_weight
from hourwatt.llm.quality import quality
from hourwatt.llm.toxicity import toxicity
from hourwatt.llm.treebpe import round_trips

#: A document goes when it is toxic rather than not, or hardly good: clean documents have to stay.
TOXIC, BAD = 0.5, 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half. All labels teach."""
    out = fresh(docs, "toxicity")
    scored = toxicity(docs, table(spark, sf_dir, "labels"), F.lit(True), out)
    return scored.where(F.col(out) < TOXIC).select(*docs.columns)


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is not low. All labels teach."""
    out = fresh(docs, "quality")
    scored = quality(docs, table(spark, sf_dir, "labels"), F.lit(True), out)
    return scored.where(F.col(out) >= BAD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights: a document occurs as often as the mix takes it."""
    out, nth = fresh(docs, "passes"), fresh(docs, "nth")
    mixed, _, _ = mix_by_weight(docs, out)
    taken = mixed.where(F.col(out) > 0).withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(out))))
    return taken.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: their number, and digests of the ids and of the decoded text."""
    return round_trips(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_bad),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Models, signatures and token ids are no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = handed_over(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
