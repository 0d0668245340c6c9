"""Operator 8: measures and verdicts against brute force; verdicts do not depend on how many copies there are."""

import math
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from hourwatt.llm import fertility as X

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measures(text, kept):
    words = WORDS.findall(text)
    tokens, pieces, from_bytes = Counter(), 0, 0
    for w in words:
        tokens.update(kept["bytes"].encode_ordinary(" " + w))
        found = kept["pieces"].encode(w)
        pieces += len(found)
        from_bytes += sum(i in kept["byte ids"] for i in found)
    n, chars = sum(tokens.values()), sum(map(len, words))
    if not n or not pieces:
        return 0, 0.0, 0.0, 0.0, 0.0
    spread = -sum(c / n * math.log(c / n) for c in tokens.values())
    return n, chars / n, chars / pieces, from_bytes / pieces, spread / math.log(n) if n > 1 else 0.0


def test_measures(spark):
    paths = [public_tokenizers.path(p) for p in ("byte_bpe_50k.tiktoken", "piece_bpe_32k.model")]
    kept = X.vocabularies(*paths)
    texts = [r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts += ["", " \n", "é", "日本語 と カナ カナ カナ", "слово слово", "a", "\x00 \x1c x\x85y", "x " * 5000, "z" * 70_000, "א ב ג ABC"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in X.measures(df).collect():
        text = texts[r.doc_id]
        want = brute_measures(text, kept)
        assert r.n_tokens == want[0] and r.script == X.script_of(text)
        assert [r[m] for m in X.MEASURES] == pytest.approx(want[1:], abs=1e-9)


def brute_kept(rows):
    """Verdicts from measures: bands by the rule, without Spark."""
    groups, languages = defaultdict(lambda: defaultdict(list)), defaultdict(lambda: defaultdict(list))
    key = lambda r: (r.script, r.lang, int(math.log2(r.n_tokens)) if r.n_tokens > 1 else 0)
    rounded = lambda r, m: round(r[m] + 1e-13, X.DIGITS)
    for r in rows:
        if r.n_words >= 50:
            for m in X.MEASURES:
                groups[key(r)][m].append(rounded(r, m))
                languages[key(r)[:2]][m].append(rounded(r, m))
    out = []
    for r in rows:
        ok = r.n_words >= 50 and 100 * r.n_repeat_words <= 50 * r.n_words
        for m in X.MEASURES if ok else ():
            mine, wide = sorted(groups[key(r)][m]), sorted(languages[key(r)[:2]][m])
            share = len(mine) / len(wide)
            weight = share / (share + X.SHARE)
            least = lambda v, k: v[(k * len(v) + 3) // 4 - 1]
            q1, q2, q3 = (weight * least(mine, k) + (1 - weight) * least(wide, k) for k in (1, 2, 3))
            low = min(q1 - X.REACH * (q3 - q1), q2 - X.LEAST_WIDTH[m])
            high = max(q3 + X.REACH * (q3 - q1), q2 + X.LEAST_WIDTH[m])
            ok = ok and low - 1e-8 <= rounded(r, m) <= high + 1e-8
        out.append(ok)
    return out


def test_verdicts(spark):
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    rows = X.measures(docs).collect()
    got = {r.doc_id: r.kept for r in X.judged(docs).collect()}
    assert [got[r.doc_id] for r in rows] == brute_kept(rows)
    assert 0.8 < sum(got.values()) / len(got) < 1


def test_copies_change_no_verdict(spark):
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    once = {r.doc_id: r.kept for r in X.judged(docs).collect()}
    many = docs.crossJoin(spark.range(6).withColumnRenamed("id", "copy"))
    many = many.withColumn("doc_id", F.col("doc_id") * 10 + F.col("copy"))
    got = X.judged(many).collect()
    assert len(got) == 6 * len(once) and all(once[r.doc_id // 10] == r.kept for r in got)


def test_a_small_language_has_its_own_bands(spark):
    """Five texts of a language that tokenises badly, among many that tokenise well."""
    rows = [(i, " ".join(f"the house number{k % 7} is here" for k in range(i, i + 30)), "en") for i in range(300)]
    rows += [(1000 + i, " ".join(f"þæœžšđ{k}ñßøå" for k in range(i, i + 120)), "xx") for i in range(5)]
    got = {r.doc_id: r for r in X.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[1000 + i].kept for i in range(5))
    assert got[1000].chars_per_token < 0.7 * got[0].chars_per_token
