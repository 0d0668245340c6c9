"""Registered queries over the sample tables, against brute force or held-out labels."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from hourwatt.llm import bagminhash as B
from hourwatt.llm.bpe import tokenizer, vocabulary_path
from hourwatt.llm.licences import BASE
from hourwatt.llm.mixing import weighted_targets
from hourwatt.llm.queries import QUERIES

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    return {r.doc_id: r for r in rows}


def result(spark, name, sf_dir=SMALL):
    return [r.asDict() for r in QUERIES[name](spark, sf_dir).collect()]


def auc(rows, labels):
    ranked = sorted((r["score"], labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels)
    ones = [i for i, (_, y) in enumerate(ranked) if y]
    zeros = len(ranked) - len(ones)
    return (sum(ones) - len(ones) * (len(ones) - 1) / 2) / (len(ones) * zeros)


@pytest.mark.parametrize("name, label, held", [
    ("op1_toxicity", "toxic", lambda c: c % 5 == 0), ("op2_quality", "quality", lambda c: c % 3 == 1),
])
def test_classifiers_on_held_out_labels(spark, name, label, held):
    rows = result(spark, name, MORE)
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{MORE}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{MORE}/documents.parquet").count()
    assert all(r["held_out"] == held(zlib.crc32(str(r["doc_id"]).encode())) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert auc([r for r in rows if r["held_out"]], labels) > 0.88


def test_mixing(spark, docs):
    rows = result(spark, "op3_mixing")
    size = {k: len(WORDS.findall(r.text or "")) for k, r in docs.items()}
    by_source = defaultdict(int)
    for k, r in docs.items():
        by_source[r.source] += size[k]
    targets, taken = weighted_targets(by_source), defaultdict(int)
    for r in rows:
        source = docs[r["doc_id"]].source
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], by_source[source])
        assert r["target"] == pytest.approx(targets[source]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    assert len(rows) == len(docs)
    for source, target in targets.items():
        smallest = min((size[k] for k in docs if docs[k].source == source and size[k]), default=0)
        assert abs(taken[source] - target) <= max(smallest, 0.05 * target) + 1
    assert sorted(map(str, rows)) == sorted(map(str, result(spark, "op3_mixing")))


def test_token_files(spark, docs):
    encoder, start = tokenizer(vocabulary_path()), 0
    rows = {r["doc_id"]: r for r in result(spark, "op4_token_files")}
    for k in sorted(docs):
        ids = encoder.encode(docs[k].text or "", add_special_tokens=False).ids + [1]
        want = {"doc_id": k, "start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))}
        assert rows[k] == want
        start += len(ids)


def test_neighbours(spark):
    rows = spark.read.parquet(f"{MORE}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    got = defaultdict(list)
    for r in sorted(result(spark, "op5_permutation_index", MORE), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append(r)
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = (x * x[i]).sum(axis=1)
        order = [k for k in np.lexsort((ids, -score)) if k != i][:20]
        mine = got[ids[i]]
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert all(r["score"] == pytest.approx(score[ids == r["vec_id"]][0], abs=1e-12) for r in mine)
        hits += len({int(ids[k]) for k in order} & {r["vec_id"] for r in mine})
    assert hits >= 0.9 * 20 * len(got)


def test_suffix_tree(spark, docs):
    words = {k: WORDS.findall((r.text or "").translate(LOWER)) + ["\n"] for k, r in docs.items()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in docs}
    counts = Counter(w for k in docs if not held[k] for w in words[k])
    n, kinds = sum(counts.values()), len(counts)
    rows = result(spark, "op6_suffix_tree")
    assert len(rows) == len(docs)
    gain = 0.0
    for r in rows:
        ws = words[r["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (n + kinds + 1)) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), n)
        assert r["n_known"] == sum(w in counts for w in ws) and r["base_score"] == pytest.approx(base)
        assert r["score"] <= 0
        gain += (r["score"] - r["base_score"]) * r["held_out"]
    assert gain > 0  # held-out texts are likelier under the tree than under the base


def test_tree_encoding(spark, docs):
    encoder = tokenizer(vocabulary_path())
    rows = result(spark, "op7_tree_bpe")
    assert len(rows) == len(docs)
    for r in rows:
        ids = encoder.encode(docs[r["doc_id"]].text or "", add_special_tokens=False).ids
        back = encoder.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_fertility(spark, docs):
    rows = result(spark, "op8_fertility", MORE)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{MORE}/documents.parquet").collect()}
    for r in rows:
        text = texts[r["doc_id"]]
        words = WORDS.findall(text)
        windows = list(zip(words, words[1:], words[2:]))
        often = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
        lines, again = set(), 0
        for line in text.split("\n"):
            if WORDS.search(line):
                again += line in lines
                lines.add(line)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed)
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == want and not (failed and r["kept"])
    passed = [r["kept"] for r in rows if not r["base_failed"]]
    assert len(rows) == len(texts) and 0.8 < sum(passed) / len(passed)


def test_licences(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{MORE}/documents.parquet").collect()}
    rows = result(spark, "op9_licences", MORE)
    assert len(rows) == len(texts)
    for r in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r["doc_id"]].translate(LOWER))
        places, labels = [], set()
        for phrase, label in BASE.items():
            parts = phrase.split()
            found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            places += found
            labels |= {label} if found else set()
        want = (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == want
        assert labels <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
        assert bool(r["labels"]) == (r["score"] > 0)


def brute_classes(texts):
    sets = {k: B.shingles(t, {}) for k, t in texts.items()}
    root = {k: k for k in texts}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    at = defaultdict(set)
    for k, (hashes, _) in sets.items():
        for h in hashes.tolist():
            at[h].add(k)
    for k, (hashes, _) in sets.items():
        for other in {o for h in hashes.tolist() for o in at[h] if o < k}:
            if B.overlap(sets[k], sets[other]) >= B.THRESHOLD:
                a, b = sorted((top(k), top(other)))
                root[b] = a
    return {k: top(k) for k in texts}


def test_near_duplicates(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{MORE}/documents.parquet").collect()}
    got = {r["doc_id"]: r["class_id"] for r in result(spark, "op10_bagminhash", MORE)}
    assert got == brute_classes(texts)


def test_pipeline(spark):
    rows = [r.asDict() for r in corpus_pipeline.run(spark, SMALL).collect()]
    encoder = tokenizer(vocabulary_path())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert rows
    classes = brute_classes(texts)
    kept = {r["doc_id"] for r in rows}
    assert len({classes[k] for k in kept}) == len(kept)  # one of each group at most
    for r in rows:
        assert r["n_tokens"] == len(encoder.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
    assert max(Counter(r["doc_id"] for r in rows).values()) <= 3
