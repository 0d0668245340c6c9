"""Operators 11 to 13: against brute force, certificates, and odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hourwatt.llm import bytebpe, whitening as W
from hourwatt.llm.bpe import tokenizer, vocabulary_path
from hourwatt.llm.collocations import coded, collocations
from hourwatt.llm.packing import VOCABULARY, best_fit, least_bins, packing
from hourwatt.llm.queries import QUERIES

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ODD = "doc_id long, text string, lang string, score double, row long, grp long, bin int, word string, x string, f int"


def odd_rows():
    prose = " ".join(f"word{i % 37} goes{i % 11}" for i in range(80))
    long_one = " ".join(f"piece{i % 5}" for i in range(9000))
    texts = [
        (1, "", "en"), (2, None, "en"), (3, "abcdefg" * 20_000, None), (None, prose, "en"), (4, prose, "en"), (4, prose, "en"),
        (5, prose, "de"), (6, " \n\t  \n\n ", "en"), (7, "the cat. The cat! THE CAT" * 20, None), (8, long_one, "fr"),
        (10, "\x00 \x01 \U0001f642 don't <|endoftext|> 中文 é", "xx"), (None, None, None), (2**60 + 1, "far id", "und"),
    ]
    return [(*r, 0.5, 1, 2, 3, "w", "v", 4) for r in texts]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD)


# packing ------------------------------------------------------------------------------------


def test_byte_ids_are_the_library_s():
    path = vocabulary_path(VOCABULARY)
    rng, signs = random.Random(5), list("ab'sS tTdlmrev  \n\n\t.,!09é×²中́한\x01\x00\x1c\x85<|>") + ["<|endoftext|>", "don't"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["word" * 50_000, " ".join(f"w{i}" for i in range(50_000)), None]
    got = list(bytebpe.encoded(path, pa.array(texts)))
    for text, ids in zip(texts, got):
        assert tokenizer(path).encode(text or "", add_special_tokens=False).ids == ids.tolist()


def fewest(sizes, room):
    """Fewest bins, by trying all ways."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= room and bins[k] not in bins[:k]:
                place(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_bounds_and_best_fit_against_all_packings():
    rng = np.random.default_rng(2)
    met = 0
    for _ in range(60):
        sizes = np.sort(rng.integers(1, 21, rng.integers(1, 9)))[::-1]
        bins, offsets, made = best_fit(sizes, 20)
        truth, bound = fewest(sizes.tolist(), 20), least_bins(sizes, 20)
        assert bound <= truth <= made
        met += bound == truth
        for b in range(made):
            order = np.argsort(offsets[bins == b])
            ends = np.cumsum(sizes[bins == b][order])
            assert ends[-1] <= 20 and offsets[bins == b][order].tolist() == [0, *ends[:-1]]
    assert met >= 50
    assert least_bins(np.full(30, 11), 20) == 30 and least_bins(np.full(30, 7), 20) == 15  # beyond the sum of sizes
    assert least_bins(np.zeros(0, int)) == 0


def check_packing(rows, texts, room=1024):
    path = vocabulary_path(VOCABULARY)
    want = Counter()
    for key, text in texts:
        ids = np.array([*tokenizer(path).encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % room or room
        cuts = [0, *range(first, len(ids) + 1, room)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[key, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= room
    return len(bins), least_bins(np.array([r.length for r in rows]), room)


def test_best_fit_query(spark):
    rows = QUERIES["op11_best_fit"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    made, bound = check_packing(rows, [(d.doc_id, d.text) for d in docs])
    assert made <= bound + 1


@pytest.mark.parametrize("per_group", [4, 60])
def test_groups_exchange_and_stay_packings(spark, odd, per_group):
    texts = [(r[0], r[1]) for r in odd_rows()]
    more = [(100 + i, "word " * (i * 37 % 300)) for i in range(150)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    rows = packing(docs, per_group=per_group).collect()
    made, bound = check_packing(rows, texts + more)
    assert made <= bound + 3
    alone = packing(docs, per_group=per_group, rounds=0).select("sequence_id").distinct().count()
    assert made <= alone


def test_packing_of_odd_rows(spark, odd):
    check_packing(packing(odd).collect(), [(r[0], r[1]) for r in odd_rows()])
    check_packing(packing(odd, room=8).collect(), [(r[0], r[1]) for r in odd_rows()], 8)
    assert packing(odd.limit(0)).count() == 0


# whitening ----------------------------------------------------------------------------------


def exact_whitening(vectors):
    """By plain integer arithmetic and the covariance's definition."""
    x = [[int(np.floor(256 * float(c))) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, d = len(fit), len(fit[0])
    total = [sum(v[i] for v in fit) for i in range(d)]
    y = [[n * v[i] - total[i] for i in range(d)] for v in fit]
    v = np.array([[sum(r[i] * r[j] for r in y) / n**3 for j in range(d)] for i in range(d)])
    e, w = np.linalg.eigh(v)
    far = [sum((n * a - t) ** 2 for a, t in zip(row, total)) for row in x]
    centred = np.array([[(n * a - t) / n for a, t in zip(row, total)] for row in x])
    return n, far, e[::-1], w[:, ::-1], centred, np.trace(v)


def check_whitening(rows, ids, vectors, most=4):
    n, far, e, w, centred, trace = exact_whitening(vectors)
    by = {(r.vec_id, r.component): r for r in rows}
    assert len(by) == len(rows) == len(ids) * most
    for k in range(most):
        mine = np.array([by[i, k + 1].whitened for i in ids])
        true = centred @ w[:, k] / np.sqrt(e[k])
        assert min(np.abs(mine - true).max(), np.abs(mine + true).max()) < 1e-8
        assert by[ids[0], k + 1].explained == pytest.approx(e[k] / trace, rel=1e-10)
    assert [by[i, 1].deviation for i in ids] == far
    assert {r.n for r in rows} == {n} and all(0 <= r.identity_error < 1e-9 for r in rows)


def test_whitening_query(spark):
    docs = spark.read.parquet(f"{MORE}/embeddings.parquet").collect()
    rows = QUERIES["op12_whitening"](spark, MORE).collect()
    check_whitening(rows, [d.vec_id for d in docs], [d.embedding for d in docs])


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=6).round(2).tolist()) for i in range(40)]
    good += [(100 + i, good[0][1]) for i in range(30)]  # copies count once in the fit
    bad = [
        (500, None), (501, []), (502, [1.0] * 5), (503, [nan] + [1.0] * 5), (504, [1.0] * 5 + [inf]), (505, [None] + [1.0] * 5),
    ]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("x", "w", "n", "v", "i")})
    rows = W.whitening(df).collect()
    check_whitening(rows, [i for i, _ in good], [v for _, v in good])
    assert W.whitening(df.limit(0)).count() == 0 and W.whitening(df.where("vec_id >= 100 and vec_id < 200")).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 1.0, 2.0 * i]) for i in range(9)] + [(None, [1.0, 1.0, 2.0])], "vec_id long, embedding array<double>")
    rows = W.whitening(flat).collect()
    assert len(rows) == 10 and {r.component for r in rows} == {1}  # one direction has all the variance


def test_squares_beyond_64_bits_are_exact():
    rng = np.random.default_rng(3)
    z = rng.integers(-(2**51), 2**51, (W.ROWS, 7))
    assert W.squares(z) == [sum(int(a) ** 2 for a in column) for column in z.T]
    big = z.astype(object) * 2**40
    assert W.squares(big) == [sum(int(a) ** 2 for a in column) for column in big.T]
    huge = W.centred(np.array([[2**62, -(2**62)]]), 5, [1, -1])
    assert huge.tolist() == [[5 * 2**62 - 1, -5 * 2**62 + 1]]


# collocations -------------------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_collocations(rows, support, best=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(zip(*[words[i:] for i in range(k)]))
    out = []
    for lang, counts in f.items():
        several = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        longer = Counter()
        for p, a in several.items():
            for i, j in combinations(range(len(p) + 1), 2):
                if j - i < len(p):
                    longer[p[i:j]] = max(longer[p[i:j]], a)
        found = []
        for p, a in several.items():
            if 100 * longer[p] < 80 * a:
                cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("shards, size", [(1, 50), (3, 200), (8, 5000), (8, 1 << 20)])
def test_collocations_of_random_words(spark, shards, size):
    rng = random.Random(shards * size)
    words = ["a", "B", "c", "É", "日本", "x-y", "d'e"]
    rows = [
        (rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n"]) for _ in range(rng.randrange(40))))
        for _ in range(120)
    ] + [("en", None), (None, ""), ("fr", " \t "), ("long", "a b c " * 3000)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = sorted(map(tuple, collocations(df, support=5, shards=shards, size=size, best=40).collect()))
    assert got == brute_collocations(rows, 5, 40)


def test_collocations_of_odd_rows(spark, odd):
    got = sorted(map(tuple, collocations(odd, support=2).collect()))
    assert got == brute_collocations([(r[2], r[1]) for r in odd_rows()], 2)
    assert collocations(odd.limit(0)).count() == 0 and collocations(odd, support=10**9).count() == 0


def test_collocations_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = sorted(map(tuple, QUERIES["op13_collocations"](spark, SMALL).collect()))
    assert got == brute_collocations([(d.lang, d.text) for d in docs], 30)


def test_words_are_cut_as_the_rule_says():
    known = {}
    ids = coded("Ab  cd\tAB.é\x1c x\n;x".encode(), known)
    assert list(known) == [b"ab", b"cd", "é\x1c".encode(), b"x"]
    assert ids.tolist() == [0, 1, 0, -1, 2, 3, -1, -1, 3]
    assert coded(b"", {}).tolist() == [] and coded(b" \t", {}).tolist() == []
