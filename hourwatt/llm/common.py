"""What several operators share: fixed patterns, table access, hand-over tables, task caches."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourwatt.session import new_folder

#: Fixed value: a word is a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_crc(column: str = "doc_id") -> Column:
    """Unsigned crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    have, name = {c.lower() for c in df.columns}, f"_{base}"
    while name.lower() in have:
        name = f"_{name}"
    return name


def handed_over(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


class Scratch:
    """Hand-over tables of one run, below one folder that is dropped when the run has its result."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.folder, self.number = spark, new_folder(spark, label), 0

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written below the folder and read back."""
        self.number += 1
        path = f"{self.folder}/{self.number}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self, result: DataFrame, label: str) -> DataFrame:
        """The result handed over on its own; everything before it is deleted."""
        out = handed_over(result, label)
        jvm, sc = self.spark._jvm, self.spark.sparkContext
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
        return out


def split_even(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows dealt by a hash of ``keys``, into as many tasks as shuffles have."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(n, 1), *keys)


def task_cache(name: str, owner: str) -> dict:
    """A dict of the Python worker, so later tasks of an operator reuse what earlier ones made.

    A worker serves one operator after the other: what the one before kept is dropped when another begins.
    """
    holder = sys.modules.setdefault("_hourwatt_task_cache", types.ModuleType("_hourwatt_task_cache"))
    if getattr(holder, "owner", None) != owner:
        holder.owner, holder.kept = owner, {}
    return holder.kept.setdefault(name, {})


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, bound: int, seed: int = 7
) -> DataFrame:
    """(text, label, pick): distinct training texts of at most ``bound`` labelled ids.

    ``train`` is a condition on ``doc_id``. Labels other than 0 and 1 and ids with both labels
    are left out; a text with both labels counts as 1. ``pick`` is a seeded number from 0 to 2^31 - 1
    that depends on the text alone, to split the sample further. The ids are broadcast: at most
    ``bound`` of them.
    """
    ids = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & train)
        .groupBy("doc_id")
        .agg(F.min(label).alias("low"), F.max(label).cast("int").alias("label"))
        .where(F.col("low") == F.col("label"))
        .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
        .limit(bound)
        .select("doc_id", "label")
    )
    pick = F.xxhash64("text", F.lit(seed)).bitwiseAND(F.lit(2**31 - 1)).alias("pick")
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(ids), "doc_id")
        .groupBy("text")
        .agg(F.max("label").alias("label"))
        .select("text", "label", pick)
    )
