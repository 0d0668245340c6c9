"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourwatt.llm import oracles
from hourwatt.llm.bagminhash import classes
from hourwatt.llm.collocations import collocations
from hourwatt.llm.common import id_crc, table
from hourwatt.llm.fertility import judged
from hourwatt.llm.licences import scan
from hourwatt.llm.mixing import mix_by_weight, words_in
from hourwatt.llm.packing import packing
from hourwatt.llm.permindex import neighbours
from hourwatt.llm.quality import quality
from hourwatt.llm.suffixtree import scores
from hourwatt.llm.tokenfile import written_and_read
from hourwatt.llm.toxicity import toxicity
from hourwatt.llm.treebpe import round_trips
from hourwatt.llm.whitening import whitening


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = id_crc() % 5 == 0
    return toxicity(docs.select("doc_id", "text"), labels, ~held, "score").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = id_crc() % 3 == 1
    return quality(docs.select("doc_id", "text"), labels, ~held, "score").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed, sizes, targets = mix_by_weight(docs, "passes")
    facts = spark.createDataFrame(
        [(s, sizes[s], float(targets[s])) for s in sizes], "name string, source_size long, target double"
    )  # a row per source
    size = words_in(F.col("text"))
    return mixed.join(F.broadcast(facts), F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", size.alias("size"), "source_size", "target", (size * F.col("passes")).alias("taken")
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_and_read(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents").select("doc_id", "text"), id_crc() % 7 != 2)


def op7_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op10_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_mixing": op3_mixing,
    "op4_token_files": op4_token_files,
    "op5_permutation_index": op5_permutation_index,
    "op6_suffix_tree": op6_suffix_tree,
    "op7_tree_bpe": op7_tree_bpe,
    "op8_fertility": op8_fertility,
    "op9_licences": op9_licences,
    "op10_bagminhash": op10_bagminhash,
    "op11_best_fit": op11_best_fit,
    "op12_whitening": op12_whitening,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {"op13_collocations": oracles.COLLOCATIONS}
