"""The tree against a plain one held in memory, and against what a share of the corpus would cut off."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hourwatt.llm import suffixtree as S


def plain_scores(texts, train, least=2, depth=3):
    """Log probabilities of texts (lists of words) under the tree, by dictionaries."""
    texts = [[*t, "END"] for t in texts]
    counts = Counter(w for t, is_train in zip(texts, train) if is_train for w in t)
    seen = list(counts.values())
    tree = S.Tree(sum(seen), len(seen), seen.count(1), seen.count(2))
    single = {w: float(tree.single(S.np.array([n]))[0]) for w, n in counts.items()}
    unknown = float(tree.single(S.np.array([0]))[0])

    def contexts(text, k):
        """The contexts before place ``k`` as long as they are of words seen twice, the text's begin as the last."""
        for d in range(1, depth + 1):
            if k - d < -1 or any(counts[w] < 2 for w in text[max(k - d, 0) : k]):
                return
            yield ("START", *text[:k]) if k - d == -1 else tuple(text[k - d : k])

    nexts = defaultdict(Counter)
    for text, is_train in zip(texts, train):
        for k, w in enumerate(text) if is_train else ():
            for c in contexts(text, k):
                nexts[c][w] += 1
    states = {}

    def chance(context, w):
        if not context:
            return single.get(w, unknown)
        shorter = chance(context[1:], w)
        if context not in states:
            return shorter
        n, kept = states[context]
        own = (kept[w] - S.DISCOUNT) / n if w in kept else 0.0
        return own + (1 - sum(c - S.DISCOUNT for c in kept.values()) / n) * shorter

    for context in sorted(nexts, key=len):
        n = sum(nexts[context].values())
        kept = {w: c for w, c in nexts[context].items() if c >= least}
        if n < least or not kept:
            continue
        expected = {w: chance(context[1:], w) for w in kept}
        rest, rest_expected = n - sum(kept.values()), 1 - sum(expected.values())
        gain = sum(c * math.log(c / n / expected[w]) for w, c in kept.items())
        if rest > 0 and rest_expected > 0:
            gain += rest * math.log(rest / n / rest_expected)
        if 2 * gain > len(kept) + 4 * math.sqrt(2 * len(kept)) + 10:
            states[context] = (n, kept)
    found = []
    for text in texts:
        logs = [math.log10(chance(max(contexts(text, k), key=len, default=()), w)) for k, w in enumerate(text)]
        found.append(sum(logs))
    return found, len(states)


@pytest.mark.parametrize("bucket_chars", [10**9, 1500, 150])
def test_tree_is_the_plain_one_however_it_is_dealt(spark, monkeypatch, bucket_chars):
    monkeypatch.setattr(S, "BUCKET_CHARS", bucket_chars)
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    phrases = [[rng.choice(words) for _ in range(rng.randint(2, 6))] for _ in range(25)]
    texts = []
    for _ in range(120):
        text = [w for _ in range(rng.randint(0, 6)) for w in rng.choice(phrases)] + rng.choices(words, k=rng.randint(0, 4))
        texts.append(text + [f"rare{rng.randint(0, 400)}"] * rng.randint(0, 2) + ["the"] * rng.randint(0, 5))
    texts += [["the"] * 40, [], texts[5], texts[5]]
    train = [k % 5 != 0 for k in range(len(texts))]
    want, states = plain_scores(texts, train)
    assert states > 50
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in S.scores(docs.repartition(5), F.col("doc_id") % 5 != 0).collect()}
    assert [got[k] for k in range(len(texts))] == pytest.approx(want)


def test_a_bucket_may_be_taken_in_parts(monkeypatch):
    rng = S.np.random.default_rng(4)
    columns = [rng.choice([S.OTHER, S.START, *range(S.FIRST, 14)], 5000) for _ in range(4)]
    columns[1][columns[1] == S.OTHER] = S.FIRST
    columns[0][columns[0] == S.START] = S.UNSEEN
    columns[0][:2000] = (columns[1][:2000] + columns[2][:2000]) % 7 + S.FIRST
    given = S.np.full(5000, 0.05), rng.random(5000) < 0.8, columns
    whole = S.refined(*given, 2, 3)
    assert (whole != 0.05).any()
    monkeypatch.setattr(S, "BATCH", 100)
    assert S.refined(*given, 2, 3) == pytest.approx(whole)


def test_what_occurs_twice_is_in_the_tree_of_a_large_corpus(spark):
    """A hundred thousand other words are no reason to forget a text that occurs twice."""
    other = spark.range(1000).select(
        F.col("id").alias("doc_id"),
        F.expr("array_join(transform(sequence(1, 120), k -> concat('v', pmod(xxhash64(id, k), 3000))), ' ')").alias("text"),
    )
    text = " ".join(f"planted{k}" for k in range(30))
    rows = S.scores(other.unionByName(spark.createDataFrame([(-1, text), (-2, text)], other.schema)), F.lit(True))
    planted = rows.where("doc_id < 0").collect()
    assert len(planted) == 2
    for r in planted:
        assert r.train_tokens == 121_062 and r.score > 31 * math.log10(0.5) and r.base_score < 31 * math.log10(0.001)
