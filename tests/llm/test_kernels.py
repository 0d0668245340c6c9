"""The parts that run inside tasks, against plain versions of the same thing."""

import io
import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hourwatt.llm import bagminhash as B
from hourwatt.llm import mixing as M
from hourwatt.llm import permindex as PI
from hourwatt.llm import quality as Q
from hourwatt.llm import suffixtree as S
from hourwatt.llm import tokenfile as TF
from hourwatt.llm import toxicity as TX
from hourwatt.llm import treebpe as TB
from hourwatt.llm.bpe import encode_texts, tokenizer, vocabulary_path

PATH = vocabulary_path()
PIECES = [
    "abc", "the ", "it's", "'s", "'", "!", "́", "̣", "é", "İ", "ß", "一", "한", "한", "1", "23",
    " ", "\n", " ", "　", "…", "<|endoftext|>", "running", "international", "xq", "ΣΑΣ", "🙂", "👩‍👩", "&&&",
    "''", "'re", "'Re", "\x1c", "\x00", " ",
]


def library_ids(text):
    return tokenizer(PATH).encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=60), st.sampled_from([2, 3, 5, 16, 64]))
def test_tree_concatenation_is_exact(parts, size):
    text = "".join(parts)
    assert TB.encode(PATH, text, size) == library_ids(text)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=80), st.sampled_from([2, 7]))
def test_tree_concatenation_of_any_text(text, size):
    assert TB.encode(PATH, text, size) == library_ids(text)


def test_tree_concatenation_of_long_unsplit_text():
    rng = random.Random(3)
    for alphabet in ("ab", "abcdefghij", "aé한"):
        text = "".join(rng.choice(alphabet) for _ in range(30_000))
        assert TB.encode(PATH, text, 512) == library_ids(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40))
def test_stretches_give_the_ids_of_the_text(parts):
    text = "".join(parts)
    got = encode_texts(PATH, [text, "", text, "Plain x9, (word)!"])
    assert [g.tolist() for g in got] == [library_ids(t) for t in (text, "", text, "Plain x9, (word)!")]


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(max_codepoint=0x180), max_size=60))
def test_stretches_of_any_latin_text(text):
    assert encode_texts(PATH, [text])[0].tolist() == library_ids(text)


def test_signatures_estimate_weighted_jaccard():
    rng, errors = np.random.default_rng(0), []
    for _ in range(40):
        base = [f"w{i}" for i in rng.integers(0, 5000, 150)] + list("abcde") * int(rng.integers(1, 60))
        other = list(base)
        for i in rng.choice(len(base), int(rng.integers(0, 25)), replace=False):
            other[i] = f"x{rng.integers(10**9)}"
        a, b = (B.shingles(" ".join(x), {}) for x in (base, other))
        s = B.signatures([a, b])
        errors.append((s[0] == s[1]).mean() - B.overlap(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_signatures_do_not_depend_on_neighbours():
    sets = [B.shingles(t, {}) for t in ("one two three four five six", "a b", "x " * 500)]
    together = B.signatures(sets)
    assert all((B.signatures([s])[0] == together[i]).all() for i, s in enumerate(sets))


def test_overlap_counts_multiplicity():
    a, b = B.shingles("p q r s t " * 3, {}), B.shingles("p q r s t " * 2, {})
    assert B.overlap(a, b) == 6 / 11  # eleven shingles and six, all of the six shared
    assert B.overlap(a, B.shingles("", {})) == 0.0


@pytest.mark.parametrize("bits", [False, True])
def test_planes_and_files_round_trip(bits):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 2**32, 1000, dtype=np.uint32)
    assert (TF.from_planes(TF.to_planes(ids, bits), len(ids)) == ids).all()
    docs = [("5", [1]), (None, list(range(300))), ("7", []), ("7", rng.integers(0, 50_000, 999).tolist())]
    stream = io.BytesIO()
    writer = TF.ShardWriter(stream, block=128, bits=bits)
    for doc in docs:
        writer.add(*doc)
    writer.close()
    reader = TF.ShardReader(stream, stream.getbuffer().nbytes)
    back = [(k, np.concatenate([np.zeros(0, np.uint32), *pieces]).tolist()) for k, pieces in reader.each()]
    assert back == docs
    everything = [i for _, ids in docs for i in ids]
    for start, stop in ((0, 1), (127, 129), (250, 1300), (5, 5)):
        assert reader.ids(start, stop).tolist() == everything[start:stop]


def test_empty_file():
    stream = io.BytesIO()
    TF.ShardWriter(stream).close()
    assert list(TF.ShardReader(stream, stream.getbuffer().nbytes).each()) == []


def test_targets():
    sizes = {"b": 10, "a": 1000, None: 500, "c": 3}
    got = M.weighted_targets(sizes)
    assert list(M.weighted_targets({})) == []
    assert got["b"] == 30 and got["c"] == 9  # weights 5, 2, 1, 5 for a, b, c and null; both reach their limit
    assert got["a"] == pytest.approx(got[None]) and sum(got.values()) == pytest.approx(1513)
    assert M.weighted_targets({"a": 0, "b": 0}) == {"a": 0.0, "b": 0.0}


def least_cost(capacity, quota, costs):
    """All ways to send words, one by one."""
    best = (0, 0)
    units = [(p, e) for p, n in capacity.items() for e in range(len(costs)) for _ in range(n)]
    for choice in itertools.product(*[[None, *p] for p, _ in units]):
        sent = {s: choice.count(s) for s in quota}
        if all(sent[s] <= quota[s] for s in quota) and all(c is None or c in quota for c in choice):
            flow = sum(sent.values())
            cost = sum(costs[e] for (_, e), c in zip(units, choice) if c is not None)
            best = max(best, (flow, -cost))
    return best


def test_flow_is_maximal_and_cheapest():
    rng = random.Random(4)
    for _ in range(12):
        capacity = {("a",): rng.randint(0, 1), ("a", "b"): rng.randint(0, 2), ("b", "c"): rng.randint(0, 1)}
        quota = {"a": rng.randint(0, 3), "b": rng.randint(0, 3), "c": rng.randint(0, 2)}
        flow = M.route(capacity, quota, (0, 1))
        total = sum(n for given in flow.values() for n in given.values())
        cost = sum(max(0, sum(given.values()) - capacity[p]) for p, given in flow.items())
        assert (total, -cost) == least_cost(capacity, quota, (0, 1))
        assert all(sum(g.get(s, 0) for g in flow.values()) <= quota[s] for s in quota)


def test_fill():
    rng = random.Random(6)
    assert M.fill([], 5) == (None, [])
    assert M.fill([(1, 6)], 5) == (None, [])
    assert M.fill([(2, 3), (1, 2)], 9) == (2, [])
    for n in (3, 8, 40):
        rows = [(i * 7 % 101, rng.randint(1, 30)) for i in range(n)]
        room = sum(w for _, w in rows) // 2
        last, later = M.fill(rows, room)
        taken = sum(w for o, w in rows if o in later or (last is not None and o <= last))
        best = max(
            sum(c) for k in range(n + 1) for c in itertools.combinations([w for _, w in rows], k) if sum(c) <= room
        ) if n < 10 else room
        assert taken == best and not {o for o in later if last is not None and o <= last}


def test_permutation_index_finds_equal_and_near():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 16))
    far = np.linalg.norm(x, axis=1).max()
    pivots = PI.lengthened(x[:128], far)
    hits = 0
    for q, (near, scores) in zip(x[:40], PI.search_block(x[:40], x, pivots, far, 10)):
        true = np.argsort(-(x * q).sum(axis=1))[:10]
        hits += len(set(true) & set(near))
        assert np.allclose(scores, (x[near] * q).sum(axis=1))
    assert hits / 400 >= 0.9


def test_probabilities_sum_to_one():
    tree = S.Tree(100, 4, 1, 1, {"x": (3, 60), "y": (4, 37)}, {(3,): (60, {4: 30, 3: 20}), (4, 3): (20, {4: 19})})
    base, arrays = 5, S.state_arrays(tree)
    single = {3: 60, 4: 37, "one": 1, "two": 2, "unknown": 0}
    for before in ([3], [4, 3], [4], []):
        total = 0.0
        for symbol, count in single.items():
            number = symbol if isinstance(symbol, int) else S.OTHER
            chances = S.probabilities(
                np.array([S.START, *before, number]),
                np.array([1.0, *tree.single(np.array([*[single[b] for b in before], count]))]), arrays, base,
            )
            total += chances[-1]
        assert total == pytest.approx(1.0)


def test_compression_difference_tells_the_classes_apart():
    rng = random.Random(5)
    good = [" ".join(rng.choice(("the", "house", "of", "cards", "was", "built")) for _ in range(80)) for _ in range(60)]
    bad = ["$$$ ".join(rng.choice(("buy", "now", "cheap", "pills", "win")) for _ in range(80)) for _ in range(60)]
    pair = Q.compressors(Q.build_dictionary(good[:40], 4096), Q.build_dictionary(bad[:40], 4096))
    assert min(Q.difference(t, *pair) for t in good[40:]) > max(Q.difference(t, *pair) for t in bad[40:])
    assert Q.difference("", *pair) == Q.difference(None, *pair) == 0.0


def test_toxic_features():
    at = dict(zip(TX.NAMES, TX.features("You are an IDIOT! he said. Nothing else here, moron", {}, {})))
    assert at["fixed_hits"] == pytest.approx(np.log1p(2)) and at["near_person"] == pytest.approx(1 / 10)
    assert at["capital_words"] == pytest.approx(1 / 10) and at["exclamations"] > 0
    masked = dict(zip(TX.NAMES, TX.features("what an id1ot", {}, {})))
    assert masked["unmasked_hits"] > 0 and masked["obfuscated"] > 0
    assert TX.features("", {}, {}) == [0.0] * len(TX.NAMES)


def test_scripts():
    from hourwatt.llm.fertility import script_of

    texts = ("abc", "123 ...", "élan vital", "Привет мир x", "日本語 ok と", "", "é", "안녕하세요")
    assert [script_of(t) for t in texts] == ["latin", "none", "latin", "cyrillic", "han", "none", "latin", "hangul"]
