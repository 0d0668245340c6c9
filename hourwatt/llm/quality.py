"""Quality by compression: zstandard dictionaries built from good and from bad labelled text.

A text is cut into blocks, each block is compressed with either dictionary, and the difference of
the summed sizes, divided by the size of the text, becomes a calibrated score by isotonic
regression on texts that built no dictionary.

Null and empty texts have the difference 0 and get its calibrated score. Without training texts
of both classes every score is 0.5. Equal texts get equal scores, an empty table an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourwatt.llm.common import fresh, handed_over, labelled_sample, task_cache

BLOCK = 256  # bytes; small, so that the dictionary counts in every block of a long text
LEVEL = 3


def cut(data: bytes, block: int = BLOCK) -> list[bytes]:
    return [data[at : at + block] for at in range(0, len(data), block)]


def build_dictionary(texts: list[str], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; the plain blocks where there is too little to train on."""
    samples = [b for text in texts for b in cut(text.encode("utf-8", "replace"))]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 10)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def compressors(good: bytes, bad: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    out = []
    for data in (good, bad):
        known = zstandard.ZstdCompressionDict(data)
        known.precompute_compress(level=LEVEL)
        out.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return out[0], out[1]


def difference(text: str | None, good, bad) -> float:
    """Bytes that the bad dictionary needs more than the good one, per byte of text."""
    data = (text or "").encode("utf-8", "replace")
    more = 0
    for block in cut(data):
        more += len(bad.compress(block)) - len(good.compress(block))
    return more / len(data) if data else 0.0


def difference_column(good: bytes, bad: bytes, text: Column) -> Column:
    key = hash((good, bad))

    @F.pandas_udf("double")
    def sizes(texts: pd.Series) -> pd.Series:
        kept = task_cache("dictionaries", "quality")
        if kept.get("key") != key:
            kept.update(key=key, pair=compressors(good, bad))
        return pd.Series([difference(t, *kept["pair"]) for t in texts], dtype="float64")

    return sizes(text)


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    scale: IsotonicRegressionModel | None

    def scored(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """``df`` with the column ``out``: 0 to 1, higher means good likelier."""
        if self.scale is None:
            return df.withColumn(out, F.lit(0.5))
        diff, level = fresh(df, "difference"), fresh(df, "level")
        scale = self.scale.copy()
        scale.setFeaturesCol(diff).setPredictionCol(level)
        df = scale.transform(df.withColumn(diff, difference_column(self.good, self.bad, F.col(text))))
        # A hundredth of the squashed difference keeps the order inside the flat steps.
        squashed = F.lit(1.0) / (F.lit(1.0) + F.exp(-20 * F.col(diff)))
        mixed = 0.99 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(level))) + 0.01 * squashed
        return df.withColumn(out, mixed).drop(diff, level)


def first_texts(sample: DataFrame, enough: int) -> list[str]:
    """Texts in the order of ``pick`` until they have ``enough`` bytes.

    Sizes are summed by range of ``pick`` first, so little more than these texts leaves the tasks.
    """
    span = F.shiftright("pick", 21)  # 1,024 ranges
    sizes = sample.groupBy(span.alias("span")).agg(F.sum(F.octet_length("text")).alias("n")).orderBy("span").collect()
    total, upto = 0, -1
    for row in sizes:
        if total >= enough:
            break
        total, upto = total + row.n, row.span
    out, total = [], 0
    for _, text in sorted(map(tuple, sample.where(span <= upto).select("pick", "text").collect())):
        if total >= enough:
            break
        out.append(text)
        total += len(text.encode("utf-8", "replace"))
    return out


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality",
    bound: int = 20_000, dictionary_size: int = 112_640, sample_bytes: int = 6_000_000,
) -> QualityModel:
    """Fit on at most ``bound`` labelled ids.

    Six tenths of the texts build the dictionaries: of each class whole texts in a seeded order until they have
    ``sample_bytes`` bytes. The rest calibrates.
    """
    sample = handed_over(labelled_sample(docs, labels, label, train, bound), "quality-sample")
    texts = {y: first_texts(sample.where((F.col("pick") % 10 < 6) & (F.col("label") == y)), sample_bytes) for y in (0, 1)}
    if not any(texts[0]) or not any(texts[1]):
        return QualityModel(b"", b"", None)
    good, bad = build_dictionary(texts[1], dictionary_size), build_dictionary(texts[0], dictionary_size)
    rest = handed_over(
        sample.where(F.col("pick") % 10 >= 6).select(
            F.col("label").cast("double").alias("label"),
            difference_column(good, bad, F.col("text")).alias("difference"),
        ),
        "quality-differences",
    )
    if rest.select("label").distinct().count() < 2:
        return QualityModel(good, bad, None)
    scale = IsotonicRegression(featuresCol="difference", labelCol="label").fit(rest.coalesce(1))
    return QualityModel(good, bad, scale)


def quality(
    docs: DataFrame, labels: DataFrame, train: Column, out: str, text: str = "text", **settings
) -> DataFrame:
    """All rows and columns of ``docs`` with the quality score ``out``."""
    return fit(docs, labels, train, **settings).scored(docs, text, out)
