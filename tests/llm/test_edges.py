"""Nulls, empty and very long texts, ties, repeated rows, empty tables, columns with clashing names."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hourwatt.llm import quality as quality_module
from hourwatt.llm.bagminhash import classes, one_per_class
from hourwatt.llm.fertility import judged
from hourwatt.llm.licences import TEMPLATES, scan
from hourwatt.llm.mixing import mix_by_weight, mixed_passes, words_in
from hourwatt.llm.permindex import neighbours
from hourwatt.llm.quality import quality
from hourwatt.llm.suffixtree import scores
from hourwatt.llm.tokenfile import written_and_read
from hourwatt.llm.toxicity import toxicity
from hourwatt.llm.treebpe import round_trips

PLAIN = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators might use themselves.
MORE = "score double, features string, label string, node string, mark int, rank int, passes int, words string, size int, word string, key string, _features int, _node int, fold int, _passes int"  # noqa: E501
PROSE = " ".join(f"word{i % 37} goes{i % 11}" for i in range(80))


def rows_of(extra):
    long_run = "abcdefg" * 30_000
    plain = [
        (1, "", "en", "a", 0), (2, None, "en", "a", None), (3, long_run, None, "b", 1), (None, PROSE, "en", None, 5),
        (4, PROSE, "en", "a", 5), (4, PROSE, "en", "a", 5), (5, PROSE, "de", "c", 5), (6, " \n\t ", "en", "a", 4),
        (7, "MIT License", None, None, None), (8, "one two three", "en", "a", 13), (9, PROSE + " tail", "en", "b", 9),
        (10, "\x00 ퟿ \U0001f642 " + "idiot " * 3, "xx", "b", 9), (None, None, None, None, None), (2**60 + 1, "far id", "en", "a", 6),
    ]
    return [(*r, 0.5, "f", "l", "n", 1, 2, 3, "w", 4, "x", "k", 5, 6, 7, 8) if extra else r for r in plain]


@pytest.fixture(params=[False, True], ids=["plain", "clashing"])
def docs(spark, request):
    return spark.createDataFrame(rows_of(request.param), PLAIN + (f", {MORE}" if request.param else ""))


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], PLAIN)


@pytest.fixture
def labels(spark):
    rows = [(4, 1, 0), (4, 1, 0), (5, 0, 1), (None, 1, 1), (8, None, None), (9, 1, 0), (10, 0, 1), (99, 1, 0), (7, 1, 0), (7, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_classifiers(spark, docs, none, labels, operator):
    got = operator(docs, labels, F.lit(True), "result")
    assert got.columns == [*docs.columns, "result"]
    rows = got.collect()
    assert len(rows) == 14 and all(0 <= r.result <= 1 for r in rows)
    assert len({r.result for r in rows if r.text == PROSE}) == 1  # equal texts, equal scores
    assert operator(none, labels, F.lit(True), "result").count() == 0
    assert operator(docs, labels.limit(0), F.lit(True), "result").count() == 14


def test_short_texts_fill_the_quality_sample(spark, monkeypatch):
    rows = [(i, f"{'good' if i % 2 else 'bad'} text {i} " + " ".join(f"w{i * k % 977}" for k in range(40))) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    sizes, build = [], quality_module.build_dictionary
    monkeypatch.setattr(quality_module, "build_dictionary", lambda texts, size: (sizes.append(sum(map(len, texts))), build(texts, size))[1])
    quality_module.fit(docs, labels, F.lit(True), sample_bytes=50_000)
    assert len(sizes) == 2 and all(50_000 <= n < 51_000 for n in sizes)


def test_mixing(spark, docs, none):
    mixed, sizes, targets = mix_by_weight(docs, "result")
    rows = mixed.collect()
    assert mixed.columns == [*docs.columns, "result"] and len(rows) == 14
    assert all(r.result <= 3 and (r.result == 0 or (r.text or "").split()) for r in rows)
    assert None in sizes and sum(targets.values()) <= sum(sizes.values()) + 1e-6
    assert mix_by_weight(none, "result")[0].count() == 0


def test_mixing_of_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a"] if i < 20 else ["a", "b"] if i < 40 else ["b", "b", None]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, names array<string>")
    got = mixed_passes(docs, F.col("names"), words_in(F.col("text")), {"a": 300.0, "b": 300.0, "z": 50.0}, "n")
    by = {tuple(r[0]): r[1] for r in got.groupBy("names").agg(F.sum(F.col("n") * 10)).collect()}
    assert sum(by.values()) == 600 and max(r.n for r in got.collect()) == 1  # no repetition is needed
    again = mixed_passes(docs, F.col("names"), words_in(F.col("text")), {"a": 1200.0}, "n")
    assert again.agg(F.sum("n")).first()[0] == 120 and again.where("names[0] = 'b'").agg(F.sum("n")).first()[0] == 0


def test_token_files(spark, docs, none):
    rows = sorted(written_and_read(docs).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 1, 2, 3, 4, 4, 5, 6, 7, 8, 9, 10, 2**60 + 1]
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(14)]
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 6)} == {1}
    assert written_and_read(none).count() == 0


def test_tree_encoding(spark, docs, none):
    rows = round_trips(docs, leaf_chars=64, piece_chars=500).collect()
    assert len(rows) == 14
    whole = {r.doc_id: r for r in round_trips(docs).collect()}
    assert all(r == whole[r.doc_id] for r in rows if r.doc_id is not None)
    empty = [r for r in rows if r.doc_id in (1, 2, 6)]
    assert {(r.n_tokens, r.ids_sha256) for r in empty} == {(0, empty[0].ids_sha256)}
    assert round_trips(none).count() == 0


def test_suffix_tree(spark, docs, none):
    rows = scores(docs, F.col("doc_id") % 2 == 0).collect()
    assert len(rows) == 14 and all(r.score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 6)} == {1}
    assert scores(docs, F.lit(False)).where("score <> 0 or base_score <> 0 or n_known > 0").count() == 0
    assert scores(none, F.lit(True)).count() == 0


def test_fertility(spark, docs, none):
    rows = judged(docs).collect()
    assert len(rows) == 14
    assert {r.base_failed for r in rows if r.doc_id in (1, 2, 3, 6, 8)} == {True}
    assert not any(r.kept for r in rows if r.base_failed)
    assert judged(none).count() == 0


def test_licences(spark, docs, none):
    rows = scan(docs).collect()
    assert len(rows) == 14
    assert [(r.n_base, r.base_labels, r.first_word) for r in rows if r.doc_id == 7] == [(1, "mit", 0)]
    assert all(r.labels == "" and r.score == 0 and r.first_word is None for r in rows if r.doc_id != 7)
    assert scan(none).count() == 0


def test_licence_templates(spark):
    text = (
        "Copyright X.\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files. Released under the MIT License; apache license, Apache License."
    )
    row = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_base, row.base_labels) == (3, "apache,mit")
    assert {"mit-grant", "mit-notice", "apache", "mit"} <= set(row.labels.split(","))


def test_phrase_of_common_words(spark):
    df = spark.createDataFrame([(1, "for the public use of it"), (2, "public use")], "doc_id long, text string")
    rows = {r.doc_id: r for r in scan(df, base={"for the public use": "x"}, templates={}).collect()}
    assert (rows[1].n_base, rows[1].base_labels, rows[1].first_word, rows[2].n_base) == (1, "x", 0, 0)


def test_text_with_all_licence_templates(spark):
    notices = "\n\n".join(f"part {i}: {sentence}." for i, (sentence, _) in enumerate(TEMPLATES.values()))
    rows = [(1, notices), *((i, "Ordinary notes, nothing else in them.") for i in range(2, 40))]
    row = scan(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).where("doc_id = 1").first()
    assert set(TEMPLATES) <= set(row.labels.split(","))


def test_near_duplicates(spark, docs, none):
    rows = classes(docs).collect()
    by_id = {r.doc_id: r.class_id for r in rows if r.doc_id is not None}
    assert len(rows) == 14
    assert by_id[4] == by_id[5] == by_id[9] == 4 and by_id[1] == 1 and by_id[2] == 2 and by_id[6] == 6
    assert classes(none).count() == 0
    kept = one_per_class(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 7, 8, 10, 2**60 + 1]
    assert one_per_class(none).count() == 0


def test_survivors_of_classes_without_own_ids(spark):
    first, second, third, fourth = (" ".join(f"{c}{i}" for i in range(30)) for c in "abcd")
    rows = [(None, first), (None, first), (None, second), (None, ""), (None, " "), (7, third), (7, fourth), (7, fourth), (7, "\n"), (8, third)]
    kept = one_per_class(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or 0, r.text) for r in kept)) == sorted(
        [(0, first), (0, second), (0, ""), (0, " "), (7, third), (7, fourth), (7, "\n")]
    )


def test_large_group_of_near_copies_is_one_class(spark):
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(600):
        words = list(base)
        words[(i * 7) % 120] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"z{i}-{k}" for k in range(60))) for i in range(50)]
    got = {r.doc_id: r.class_id for r in classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {got[i] for i in range(600)} == {0} and all(got[1000 + i] == 1000 + i for i in range(50))


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7 + 1), float(i % 3), 1.0]) for i in range(60)]
    rows += [(20, [1.0, 0.0, 1.0]), (100, None), (120, [0.0, 0.0, 0.0]), (140, [nan, 1.0, 1.0]), (160, [inf, 1.0, 1.0])]
    rows += [(180, [1.0, None, 1.0]), (200, [1.0]), (None, [1.0, 1.0, 1.0]), (40, [5.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, group string, v int, id int" if False else "vec_id long, embedding array<double>")
    got = neighbours(df.withColumn("group", F.lit(1)).withColumn("v", F.lit(2)), F.col("id") % 20 == 0, 5).collect()
    assert {r.query_id for r in got} == {0, 20, 40}
    assert all(r.vec_id != r.query_id and r.vec_id < 60 for r in got)
    first = sorted((r for r in got if r.query_id == 0), key=lambda r: r["rank"])
    assert [r["rank"] for r in first] == [1, 2, 3, 4, 5]
    assert [(-r.score, r.vec_id) for r in first] == sorted((-r.score, r.vec_id) for r in first)
    assert neighbours(df.limit(0), F.lit(True), 5).count() == 0
    assert neighbours(df.where("vec_id < 3"), F.col("id") == 0, 5).count() == 2


@pytest.mark.parametrize("hot", [False, True])
def test_recall_with_many_near_copies(spark, hot):
    rng = np.random.default_rng(3)
    spots = rng.normal(size=(2000, 64))
    n, copies = 12_288, 4_096 if hot else 0
    x = np.vstack([
        spots[rng.integers(0, 2000, n - copies)] + 0.3 * rng.normal(size=(n - copies, 64)),
        spots[7] + 0.02 * rng.normal(size=(copies, 64)),
    ])
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(n), "embedding": x.tolist()}))
    found = {}
    for r in neighbours(df, F.col("id") % 24 == 0, 20).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    shares = {}
    for i in range(0, n, 24):
        best = [k for k in np.argsort(-(x @ x[i]))[:21].tolist() if k != i][:20]
        shares.setdefault(i >= n - copies, []).append(len(found[i].intersection(best)) / 20)
    assert all(np.mean(some) >= 0.9 for some in shares.values())


def test_pipeline_stages(spark, docs, none, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for frame in (docs, none):
        now = frame
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, str(tmp_path))
            if name != "encoding":
                assert out.columns == frame.columns
                now = out
            out.collect()
