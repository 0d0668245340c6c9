"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features are densities of lexicon words, how near they stand to a second person, and rates of
capitals, punctuation and obfuscated spelling. The lexicon is a fixed word list plus word starts
learned from the labelled sample. Features of a training text use lexicon counts of the other
folds only. Trees and calibration are Spark ML models, fitted on disjoint parts of the sample.

Null and empty texts have zero features and get the score the model gives those. Without training
texts of both classes the score is the share of lexicon words, 0 for none. Rows are scored one by
one: repeated rows and ties get equal scores, an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourwatt.llm.common import fresh, handed_over, labelled_sample, task_cache

# Insults, and pronouns of the second person, in English, German, French, Spanish.
INSULTS = frozenset(
    """idiot idiots moron morons stupid dumb clown loser losers scum trash garbage worthless pathetic
    disgusting filth vermin imbecile cretin jerk bastard bitch asshole shit fuck fucking bullshit
    dumbass retard scumbag pig freak hate kill ugly
    idiotin dumm dummkopf arschloch scheisse scheiße abschaum trottel wertlos widerlich ekelhaft
    versager hurensohn schwein
    idiote imbécile débile crétin connard connasse merde salaud salope ordure minable dégoûtant
    stupide nul
    idiota imbécil estúpido estúpida tonto basura escoria inútil mierda cabrón asqueroso patético
    perdedor""".split()
)
SECOND_PERSON = frozenset(
    """you your yours yourself u ur du dich dir dein deine deinen euch euer ihr sie tu te toi ton ta
    tes vous votre vos usted ustedes ti tus vosotros os""".split()
)
_LISTED = INSULTS | SECOND_PERSON
FOLDS = 4
KEPT = 400_000  # runs of characters that a worker keeps, over all folds
NAMES = (
    "fixed_density fixed_hits learned_density learned_top learned_kinds learned_hits near_person"
    " person_density capitals capital_words punctuation exclamations symbols obfuscated"
    " unmasked_hits stretched log_words"
).split()

_TOKEN = re.compile(r"[^\W\d_]+(?:[*@$!|0-9]+[^\W\d_]+)*")
_SYMBOLS = "#*$%&|<>"
_PUNCTUATION = ".,;:!?'\"()[]-"
_STRETCH = re.compile(r"([^\W\d_])\1\1")
_MASKS = str.maketrans("@$!|013457", "asiloieast")


def stems(word: str) -> tuple[str, ...]:
    """The word, and its starts of four to six letters: endings vary, the stem does not."""
    if len(word) < 4:
        return (word,)
    return (word, *(word[:n] for n in (4, 5, 6) if n < len(word)))


@dataclass
class Lexicon:
    """Learned stems: (toxic, other) document counts per fold, and the documents per fold."""

    counts: dict[str, tuple[tuple[int, ...], tuple[int, ...]]] = field(default_factory=dict)
    docs: tuple[tuple[int, ...], tuple[int, ...]] = ((0,) * FOLDS, (0,) * FOLDS)

    def weights(self, without: int | None = None) -> dict[str, float]:
        """Log odds of the stems that pass the test, counted without one fold."""
        rest = [f for f in range(FOLDS) if f != without]
        n1, n0 = (sum(d[f] for f in rest) for d in self.docs)
        out = {}
        for stem, (toxic, other) in self.counts.items():
            a, b = sum(toxic[f] for f in rest), sum(other[f] for f in rest)
            if evidence(a, b, n1, n0) >= LEAST_EVIDENCE:
                out[stem] = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
        return out


LEAST_EVIDENCE = 20.0


def evidence(a: int, b: int, n1: int, n0: int) -> float:
    """Log-likelihood ratio that a stem is commoner in toxic texts; 0 if it is not twice as common."""
    if not n1 or not n0 or a < 3 or a * n0 <= 2 * b * n1:
        return 0.0
    total, share = a + b, n1 / (n1 + n0)
    out = a * math.log(a / (total * share))
    if b:
        out += b * math.log(b / (total * (1 - share)))
    return 2 * out


def looked_up(chunk: str, weights: dict[str, float]) -> int | tuple:
    """What a run of characters between blanks adds to the counts.

    Its number of words if it adds nothing else, otherwise (words, fixed hits, learned hits, sum of their
    weights, largest weight, its stem, persons, odd spellings, unmasked hits, words in capitals,
    capitals, stretched words).
    """
    if chunk.isalpha() and chunk.islower() and not any(s in weights or s in _LISTED for s in stems(chunk)):
        if not _STRETCH.search(chunk):
            return 1
    words = _TOKEN.findall(chunk)
    fixed = learned = persons = odd = unmasked = upper = stretched = 0
    total, top, top_stem = 0.0, 0.0, ""
    for word in words:
        low = word.lower()
        plain = low if low.isalpha() else low.translate(_MASKS)
        best, stem = max(((weights[s], s) for s in stems(plain) if s in weights), default=(0.0, ""))
        fixed += low in INSULTS
        persons += low in SECOND_PERSON
        odd += not word.isalpha()
        unmasked += plain != low and (plain in INSULTS or best > 0)
        upper += len(word) > 1 and word.isupper()
        stretched += _STRETCH.search(word) is not None
        if stem:
            learned += 1
            total += best
            if best > top:
                top, top_stem = best, stem
    capitals = sum(map(str.isupper, chunk))
    if fixed or learned or persons or odd or unmasked or capitals or stretched:
        return len(words), fixed, learned, total, top, top_stem, persons, odd, unmasked, upper, capitals, stretched
    return len(words)


def features(text: str, weights: dict[str, float], known: dict) -> list[float]:
    """The dense features; ``known`` keeps what was found out about a run of characters."""
    out = [0.0] * len(NAMES)
    chunks = text.split()
    if not chunks:
        return out
    n = fixed = learned = odd = unmasked = upper = capitals = stretched = 0
    top, total, kinds = 0.0, 0.0, set()
    person: list[int] = []
    hits: list[int] = []
    for chunk in chunks:
        found = known.get(chunk)
        if found is None:
            found = known[chunk] = looked_up(chunk, weights)
        if found.__class__ is int:
            n += found
            continue
        words, f, k, weight, high, stem, persons, o, u, caps, c, s = found
        fixed, odd, unmasked, upper = fixed + f, odd + o, unmasked + u, upper + caps
        capitals, stretched = capitals + c, stretched + s
        if k:
            learned, total, top = learned + k, total + weight, max(top, high)
            kinds.add(stem)
        if persons:
            person.append(n)
        if f or k or u:
            hits.append(n)
        n += words
    near = 0
    if hits and person:
        at = np.searchsorted(person, hits)
        spots = np.array([-9, *person, 10**9])
        here = np.array(hits)
        near = int(((here - spots[at] <= 4) | (spots[at + 1] - here <= 4)).sum())
    n, chars = max(n, 1), len(text)
    out[:] = (
        fixed / n, math.log1p(fixed), total / n, top, math.log1p(len(kinds)), math.log1p(learned),
        near / n, len(person) / n, capitals / chars, upper / n,
        sum(map(text.count, _PUNCTUATION)) / chars, text.count("!") / chars, sum(map(text.count, _SYMBOLS)) / chars,
        odd / n, math.log1p(unmasked), stretched / n, math.log1p(n),
    )
    return out


def learn_lexicon(sample: DataFrame, size: int) -> Lexicon:
    """Counts of at most ``size`` stems: those with the strongest evidence over all folds."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[int, int], Counter] = {}
        for batch in batches:
            for text, label, pick in zip(batch.text, batch.label, batch.pick):
                kinds = {s for w in set(_TOKEN.findall(text.lower())) for s in stems(w.translate(_MASKS) if not w.isalpha() else w)}
                seen.setdefault((int(pick) % FOLDS, int(label)), Counter()).update(kinds)
        for (fold, label), counts in seen.items():
            rows = list(counts.items())
            for at in range(0, len(rows), 100_000):
                part = rows[at : at + 100_000]
                yield pd.DataFrame(
                    {"stem": [s for s, _ in part], "fold": fold, "label": label, "n": [c for _, c in part]}
                )

    per_fold = sample.groupBy((F.col("pick") % FOLDS).cast("int").alias("fold"), "label").count()
    docs = [[0] * FOLDS, [0] * FOLDS]
    for fold, label, n in per_fold.collect():
        docs[label][fold] = n
    n1, n0 = sum(docs[1]), sum(docs[0])
    if not n1 or not n0:
        return Lexicon()
    cells = [
        F.sum(F.when((F.col("fold") == f) & (F.col("label") == y), F.col("n")).otherwise(0)).alias(f"c{y}{f}")
        for y in (1, 0) for f in range(FOLDS)
    ]
    a = sum((F.col(f"c1{f}") for f in range(FOLDS)), F.lit(0))
    b = sum((F.col(f"c0{f}") for f in range(FOLDS)), F.lit(0))
    share = n1 / (n1 + n0)
    ratio = 2 * (
        a * F.log(a / ((a + b) * share))
        + F.when(b > 0, b * F.log(b / ((a + b) * (1 - share)))).otherwise(0.0)
    )
    rows = (
        sample.mapInPandas(count, "stem string, fold int, label int, n long")
        .groupBy("stem")
        .agg(*cells)
        .where((a >= 3) & (a * n0 > 2 * b * n1))
        .withColumn("g", ratio)
        .where(F.col("g") >= LEAST_EVIDENCE)
        .orderBy(F.desc("g"), "stem")
        .limit(size)
        .collect()
    )
    counts = {r[0]: (tuple(r[1 : 1 + FOLDS]), tuple(r[1 + FOLDS : 1 + 2 * FOLDS])) for r in rows}
    return Lexicon(counts, (tuple(docs[1]), tuple(docs[0])))


def features_column(lexicon: Lexicon, text: Column, fold: Column | None = None) -> Column:
    """Array of features; ``fold`` names the fold whose counts a row must not see."""
    key = hash((tuple(sorted(lexicon.counts)), lexicon.docs))

    def tables() -> dict:
        kept = task_cache("words", "toxicity")
        if kept.get("key") != key:
            kept.clear()
            kept.update(key=key, **{str(f): lexicon.weights(f) for f in (None, *range(FOLDS))})
            kept.update(known={str(f): {} for f in (None, *range(FOLDS))})
        return kept

    def row(value: str | None, f: int | None, kept: dict) -> list[float]:
        if sum(map(len, kept["known"].values())) > KEPT:
            for known in kept["known"].values():
                known.clear()
        return features(value or "", kept[str(f)], kept["known"][str(f)])

    @F.pandas_udf("array<double>")
    def plain(texts: pd.Series) -> pd.Series:
        kept = tables()
        return pd.Series([row(t, None, kept) for t in texts], dtype=object)

    @F.pandas_udf("array<double>")
    def crossed(texts: pd.Series, folds: pd.Series) -> pd.Series:
        kept = tables()
        return pd.Series([row(t, int(f), kept) for t, f in zip(texts, folds)], dtype=object)

    return plain(text) if fold is None else crossed(text, fold)


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    scale: IsotonicRegressionModel | None

    def scored(self, df: DataFrame, text: str, out: str) -> DataFrame:
        """``df`` with the column ``out``: 0 to 1, higher means toxic likelier."""
        raw = fresh(df, "features")
        df = df.withColumn(raw, features_column(self.lexicon, F.col(text)))
        if self.trees is None:
            return df.withColumn(out, F.least(F.col(raw)[0], F.lit(1.0))).drop(raw)
        vec, margin, odds, label = (fresh(df, x) for x in ("vector", "margin", "odds", "leaf"))
        chance, level = fresh(df, "chance"), fresh(df, "level")
        trees = self.trees.copy()
        trees.setFeaturesCol(vec).setRawPredictionCol(margin).setProbabilityCol(odds).setPredictionCol(label)
        df = trees.transform(df.withColumn(vec, array_to_vector(raw)))
        df = df.withColumn(chance, vector_to_array(odds)[1])
        if self.scale is None:
            return df.withColumn(out, F.col(chance)).drop(raw, vec, margin, odds, label, chance)
        scale = self.scale.copy()
        scale.setFeaturesCol(chance).setPredictionCol(level)
        df = scale.transform(df)
        # A hundredth of the uncalibrated chance keeps the order inside the flat steps.
        mixed = 0.99 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(level))) + 0.01 * F.col(chance)
        return df.withColumn(out, mixed).drop(raw, vec, margin, odds, label, chance, level)


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, label: str = "toxic",
    bound: int = 20_000, lexicon_size: int = 4_000, trees: int = 25, depth: int = 3,
) -> ToxicityModel:
    """Fit on at most ``bound`` labelled ids. Seven tenths of the texts grow the trees, the rest calibrates."""
    sample = handed_over(labelled_sample(docs, labels, label, train, bound), "toxic-sample")
    lexicon = learn_lexicon(sample, lexicon_size)
    if not sum(lexicon.docs[0]) or not sum(lexicon.docs[1]):
        return ToxicityModel(lexicon, None, None)
    fold = (F.col("pick") % FOLDS).cast("int")
    table = handed_over(
        sample.select(
            F.col("label").cast("double").alias("label"),
            features_column(lexicon, F.col("text"), fold).alias("raw"),
            (F.floor(F.col("pick") / FOLDS) % 10 < 7).alias("grow"),
        ),
        "toxic-features",
    ).coalesce(4)
    table = table.withColumn("features", array_to_vector("raw"))
    both = {(g, y) for g, y in table.select("grow", "label").distinct().collect()}
    if not {(True, 0.0), (True, 1.0)} <= both:
        return ToxicityModel(lexicon, None, None)
    grown = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2,
        minInstancesPerNode=3, maxBins=64, seed=11,
    ).fit(table.where("grow"))
    if not {(False, 0.0), (False, 1.0)} <= both:
        return ToxicityModel(lexicon, grown, None)
    held = grown.transform(table.where(~F.col("grow"))).select(
        "label", vector_to_array("probability")[1].alias("chance")
    )
    scale = IsotonicRegression(featuresCol="chance", labelCol="label").fit(held.coalesce(1))
    return ToxicityModel(lexicon, grown, scale)


def toxicity(
    docs: DataFrame, labels: DataFrame, train: Column, out: str, text: str = "text", **settings
) -> DataFrame:
    """All rows and columns of ``docs`` with the toxicity score ``out``."""
    return fit(docs, labels, train, **settings).scored(docs, text, out)
