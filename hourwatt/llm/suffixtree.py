"""LM scoring with a probabilistic suffix tree over words.

Words are counted in the training texts. Every context of one, two and three symbols that occurs ``least`` times or more
is a candidate, and every next symbol that follows it ``least`` times counts; ``least`` is a number of occurrences,
not a share, so the tree grows with the corpus. A candidate is retained if its next-symbol distribution diverges from that of its
longest retained suffix by more than its counts explain. The longest suffix state of a position
gives the next symbol's probability: its discounted count, and the rest of the mass by the next
shorter state, down to the single-word distribution, whose discount goes to one unknown symbol.

Texts are tokenised once, into blocks of bounded size with a vocabulary each. A block's words go to buckets, which count
them over all blocks and number them. Then every place (a symbol with the three before it) goes to the bucket
of the word before it. All contexts that end in that word lie there, so the bucket grows their states and refines its places' probabilities
on its own; no part of the tree leaves it. Sums of log probabilities by text come back to the block.

Null texts count as empty: one token, the end. Without training texts nothing is known and the
unknown symbol has probability 1. Repeated rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourwatt.llm.common import handed_over, split_even

LEAST, DEPTH = 2, 3  # what occurs once is no evidence of what follows it
BLOCK_CHARS, BUCKET_CHARS, BATCH = 10_000_000, 12_000_000, 1 << 19
END, START, OTHER, UNSEEN, FIRST = 0, 1, 2, 3, 4  # the end, the place before a text, words seen once and never, first word
END_WORD = "\n"  # no word holds a line end
DISCOUNT = 0.6


def words_of(text: str) -> list[bytes]:
    """Lower-cased words in UTF-8, then the end. Bytes are lowered and split at ASCII only."""
    out = text.encode("utf-8", "replace").lower().split()
    out.append(END_WORD.encode())
    return out


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def planes(values: np.ndarray) -> np.ndarray:
    """Whole numbers as all lowest bytes, then all next ones and so on, which packs better."""
    return np.ascontiguousarray(values, np.int64).view(np.uint8).reshape(-1, 8).T.copy()


def whole(data: np.ndarray) -> np.ndarray:
    """The numbers of ``planes``."""
    return np.ascontiguousarray(data.reshape(8, -1).T).view(np.int64).ravel()


BLOCK_ROWS = T.StructType(
    [
        T.StructField("block", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.StringType())),
        T.StructField("train", T.ArrayType(T.BooleanType())), T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("numbers", T.BinaryType()), T.StructField("bucket", T.LongType()),
        T.StructField("words", T.BinaryType()), T.StructField("counts", T.BinaryType()),
    ]
)


def blocks(docs: DataFrame, train: Column, text: str, buckets: int, size: int = BLOCK_CHARS) -> DataFrame:
    """Rows of two kinds: a block's texts as numbers of its words; the words of a block that fall to
    one bucket, with their numbers and training counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId() << 32
        known: dict[bytes, int] = {END_WORD.encode(): 0}
        held: list[tuple[list, list, list, np.ndarray]] = []
        chars = block = 0

        def closed() -> Iterator[pd.DataFrame]:
            ids, train, sizes = ([x for rows in held for x in rows[k]] for k in range(3))
            numbers = np.concatenate([rows[3] for rows in held])
            order = np.argsort(-np.bincount(numbers, minlength=len(known)), kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order))
            numbers = rank[numbers]  # frequent words get small numbers, which pack well
            seen = np.bincount(numbers[np.repeat(train, sizes)], minlength=len(known))
            yield pd.DataFrame(
                {
                    "block": [part + block], "doc_ids": [ids], "train": [train], "sizes": [sizes],
                    "numbers": [packed(planes(numbers))], "bucket": pd.Series([None], dtype="Int64"), "words": [None],
                    "counts": [None],
                }
            )
            names = [b"", *list(known)[1:]]  # the end goes as the empty word
            names = [names[k] for k in order]
            mine = np.fromiter((zlib.crc32(w) % buckets for w in names), np.int64, len(names))
            order = np.argsort(mine, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(mine[order])) + 1):
                yield pd.DataFrame(
                    {
                        "block": [part + block], "doc_ids": [None], "train": [None], "sizes": [None],
                        "numbers": [packed(np.diff(some, prepend=0).astype(np.int32))], "bucket": [mine[some[0]]],
                        "words": [packed(np.frombuffer(b"\n".join([names[k] for k in some]), np.uint8))],
                        "counts": [packed(seen[some])],
                    }
                )

        for big in batches:
            for at in range(0, len(big), 256):
                batch = big.iloc[at : at + 256]
                lists = [words_of(t) for t in batch.text]
                for words in lists:
                    for w in set(words).difference(known):
                        known[w] = len(known)
                coded = [np.fromiter(map(known.__getitem__, words), np.int32, len(words)) for words in lists]
                sizes = [len(c) for c in coded]
                held.append((batch.doc_id.tolist(), batch.train.tolist(), sizes, np.concatenate(coded)))
                chars += int(batch.text.str.len().sum())
                if chars > size:
                    yield from closed()
                    known, held, chars, block = {END_WORD.encode(): 0}, [], 0, block + 1
        if held:
            yield from closed()

    rows = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    return rows.mapInPandas(run, BLOCK_ROWS)


@dataclass
class Tree:
    """The model but for the single-word counts of rare words.

    ``common`` numbers the common words, ``states`` has of each retained context (older symbol
    first) its count and its kept next symbols with counts.
    """

    tokens: int = 0
    kinds: int = 0
    once: int = 0
    twice: int = 0
    common: dict[str, tuple[int, int]] = field(default_factory=dict)
    states: dict[tuple[int, ...], tuple[int, dict[int, int]]] = field(default_factory=dict)

    def loss(self) -> float:
        """The count taken from every known word, estimated from words seen once and twice."""
        return min(0.9, self.once / (self.once + 2 * self.twice)) if self.once else 0.5

    def single(self, count: np.ndarray) -> np.ndarray:
        """Probabilities of words with these counts; the unknown symbol for 0."""
        if not self.tokens:
            return np.ones(len(count))
        unknown = max(self.loss() * self.kinds, 0.5) / self.tokens
        scale = (1 - unknown) / (1 - self.loss() * self.kinds / self.tokens)
        return np.where(count > 0, (count - self.loss()) / self.tokens * scale, unknown)


def state_arrays(tree: Tree) -> dict[int, tuple]:
    """By length: sorted context keys, mass left to the suffix, sorted (context, symbol) keys, probabilities."""
    base = len(tree.common) + 3
    out = {}
    for depth in range(1, DEPTH + 1):
        states = sorted((key_of(c, base), n, nexts) for c, (n, nexts) in tree.states.items() if len(c) == depth)
        if not states:
            continue
        pairs = sorted((k * base + s, (c - DISCOUNT) / n) for k, n, nexts in states for s, c in nexts.items())
        left = [1 - sum(c - DISCOUNT for c in nexts.values()) / n for _, n, nexts in states]
        out[depth] = (
            np.array([k for k, _, _ in states], np.int64), np.array(left),
            np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs]),
        )
    return out


def key_of(context: tuple[int, ...], base: int) -> int:
    out = 0
    for s in context:
        out = out * base + s
    return out


def stream_of(texts: list[np.ndarray]) -> np.ndarray:
    """The texts one after the other, each behind a START."""
    start = np.array([START], np.int64)
    return np.concatenate([x for t in texts for x in (start, t)]) if texts else start[:0]


def context_keys(stream: np.ndarray, base: int, depth: int) -> np.ndarray:
    """The key of the ``depth`` symbols before each position; -1 where one is rare or of another text."""
    n = len(stream)
    padded = np.concatenate([np.full(depth, OTHER, np.int64), stream])
    out, bad = np.zeros(n, np.int64), stream == START
    for k in range(depth):
        part = padded[k : k + n]
        bad |= (part == OTHER) | (part == END)
        if k:
            bad |= part == START  # only the oldest symbol can be the place before the text
        out = out * base + part
    return np.where(bad, -1, out)


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in the sorted ``keys``, -1 where absent."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1) if len(keys) else np.full(len(wanted), -1)


def probabilities(stream: np.ndarray, single: np.ndarray, arrays: dict[int, tuple], base: int) -> np.ndarray:
    """Probability of each symbol after those before it; shorter states first, each refined by the next."""
    out = single
    for depth in sorted(arrays):
        keys, left, pairs, share = arrays[depth]
        at = find(keys, context_keys(stream, base, depth))
        inside = np.flatnonzero(at >= 0)
        symbols, state = stream[inside], at[inside]
        place = find(pairs, np.where(symbols == OTHER, -1, keys[state] * base + symbols))
        own = np.where(place >= 0, share[np.maximum(place, 0)], 0.0) if len(pairs) else 0.0
        out = out.copy()
        out[inside] = own + left[state] * out[inside]
    return out


WORDS = (
    "block long, numbers binary, counts binary, symbols binary, tokens long, kinds long, once long, twice long, top long"
)


def count_words(buckets: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Each block's words of a bucket with their counts in all training texts and their symbols, and the bucket's totals.

    A word that occurs once, or in no training text, has no symbol of its own.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows.bucket.iloc[0])
        lists = [unpacked(data, np.uint8).tobytes().split(b"\n") for data in rows.words]
        sizes = [len(x) for x in lists]
        found = pa.array([w for x in lists for w in x], pa.binary()).dictionary_encode()
        at = found.indices.to_numpy()
        total = np.zeros(len(found.dictionary), np.int64)
        np.add.at(total, at, np.concatenate([unpacked(data, np.int64) for data in rows.counts]))
        symbol = np.zeros(len(total), np.int64)  # frequent words get small numbers, which pack well
        symbol[np.argsort(-total, kind="stable")] = FIRST + bucket + buckets * np.arange(len(total))
        symbol[total == 1], symbol[total == 0] = OTHER, UNSEEN
        end = found.dictionary.index(b"").as_py()
        if end >= 0:
            symbol[end] = END
        cuts = np.cumsum(sizes)[:-1]
        first = [1] + [0] * (len(rows) - 1)
        sums = {"tokens": total.sum(), "kinds": (total > 0).sum(), "once": (total == 1).sum(), "twice": (total == 2).sum(), "top": symbol.max()}
        return pd.DataFrame(
            {
                "block": rows.block, "numbers": rows.numbers, "counts": [packed(x) for x in np.split(total[at], cuts)],
                "symbols": [packed(x) for x in np.split(symbol[at], cuts)], **{k: np.multiply(first, v) for k, v in sums.items()},
            }
        )

    return run


PLACES = (
    "bucket long, block long, n int, counts binary, places binary, texts binary, train binary,"
    " doc_ids array<string>, facts binary"
)
FACTS = [("train", "?"), ("size", "i8"), ("known", "i8"), ("base", "f8"), ("rest", "f8")]


def placed(model: Tree, buckets: int, depth: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Every place of a block's texts, dealt by the word before it; what needs no context is summed up here."""

    cells = [c.split()[0] for c in PLACES.split(", ")]

    def run(texts: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        if not len(texts):
            return pd.DataFrame(columns=cells)
        block = int(texts.block.iloc[0])
        number = np.concatenate([np.cumsum(unpacked(x, np.int32), dtype=np.int64) for x in words.numbers])
        count, symbol = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        count[number] = np.concatenate([unpacked(x, np.int64) for x in words.counts])
        symbol[number] = np.concatenate([unpacked(x, np.int64) for x in words.symbols])

        at = whole(unpacked(texts.numbers.iloc[0], np.uint8))
        sizes = np.asarray(texts.sizes.iloc[0], np.int64)
        train = np.asarray(texts.train.iloc[0], bool)
        begins = np.cumsum(sizes) - sizes  # no text is without its end
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        facts = np.zeros(len(sizes), FACTS)
        facts["train"], facts["size"] = train, sizes
        facts["known"] = np.add.reduceat((count[at] > 0).astype(np.int64), begins)
        facts["base"] = np.add.reduceat(np.log10((count[at] + 1) / (model.tokens + model.kinds + 1)), begins)

        columns, inside = [symbol[at]], np.arange(len(at)) - begins[owner]
        for k in range(1, depth + 1):
            before = np.full(len(at), OTHER)
            before[k:] = columns[0][:-k]
            before[inside == k - 1] = START
            before[inside < k - 1] = OTHER
            columns.append(before)
        use = (columns[1] != OTHER) & (columns[1] != UNSEEN)
        alone = np.flatnonzero(~use)
        np.add.at(facts["rest"], owner[alone], np.log10(model.single(count[at[alone]])))
        out = [
            {"bucket": block % buckets, "block": block, "n": 0, "doc_ids": texts.doc_ids.iloc[0], "facts": packed(facts)}
        ]
        used = np.flatnonzero(use)
        mine = (columns[1][used] - FIRST) % buckets
        order = np.argsort(mine, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(mine[order])) + 1):
            if not len(some):
                continue
            here = used[some]
            _, one = grouped(columns[0][here])
            out.append(
                {
                    "bucket": mine[some[0]], "block": block, "n": len(here), "counts": packed(planes(count[at[here[one]]])),
                    "places": packed(np.concatenate([planes(c[here] // (buckets if k == 1 else 1)).ravel() for k, c in enumerate(columns)])),
                    "texts": packed(np.diff(owner[here], prepend=np.int32(0))), "train": packed(train[owner[here]]),
                }
            )
        return pd.DataFrame({c: [row.get(c) for row in out] for c in cells})

    return run


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each key's group, in key order, and one place of each group."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    group = np.empty(len(keys), np.int64)
    group[order] = np.cumsum(new) - 1
    return group, order[new]


def batches(n: int, key: Callable[[slice], np.ndarray], size: int) -> Iterator[np.ndarray]:
    """Places dealt by key into parts of about ``size``; equal keys stay together, places with key -1 are left out."""
    parts = min(n // size + 1, 60_000)
    part = np.empty(n, np.uint16)
    for at in range(0, n, 1 << 18):
        some = slice(at, at + (1 << 18))
        keys = key(some).astype(np.int64)
        dealt = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)
        part[some] = np.where(keys < 0, parts, dealt)
    for k in range(parts):
        at = np.flatnonzero(part == k)
        if len(at):
            yield at


def counted(
    chance: np.ndarray, context: np.ndarray, symbols: np.ndarray, train: np.ndarray, n: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """The own share of each place's symbol after its context, and by context the sums that ``judged`` takes."""
    pair, one = grouped(context * (int(symbols.max()) + 1) + symbols)
    c = np.bincount(pair[train], minlength=len(one))
    kept = np.flatnonzero((c >= least) & (symbols[one] != OTHER))  # a word that was never seen has no count
    of, c, expected = context[one[kept]], c[kept], chance[one[kept]]
    own = np.zeros(len(one))
    own[kept] = (c - DISCOUNT) / n[of]
    sums = (np.ones(len(of)), c, expected, c * np.log(c / n[of] / expected))
    return own[pair], np.array([np.bincount(of, x, len(n)).astype(float) for x in sums])


def refined(
    chance: np.ndarray, train: np.ndarray, columns: list[np.ndarray], least: int, depth: int, buckets: int = 1
) -> np.ndarray:
    """Probability of each place's symbol (``columns[0]``) after those before it (``columns[1:]``, nearest first).

    The places hold all occurrences of their contexts. Context by context length: counts of the next symbols in the
    training places, the divergence test against the shorter state, and the refinement by what is retained. Contexts of one symbol
    are counted next symbol by next symbol, longer ones by their last two symbols, so the work takes parts of bounded size.
    Only the oldest symbol of a context can be the place before the text.
    """
    symbols, *before = columns
    context = before[0] // buckets
    n = np.bincount(context[train])
    n = np.append(n, np.zeros(int(context.max()) + 1 - len(n), np.int64))
    own, sums = np.zeros(len(symbols)), np.zeros((4, len(n)))
    for at in batches(len(symbols), lambda some: symbols[some], BATCH):
        own[at], more = counted(chance[at], context[at].astype(np.int64), symbols[at].astype(np.int64), train[at], n, least)
        sums += more
    retained, left = judged(n, *sums)
    own *= retained[context]
    own += np.where(retained, left, 1.0)[context] * chance
    chance = own
    if depth == 1:
        return chance
    width = max(int(c.max()) for c in before) + 1
    often = n >= least

    def two_back(some: slice) -> np.ndarray:
        """The last two symbols; -1 where the text begins or a word is unknown."""
        near, far = before[0][some], before[1][some].astype(np.int64)
        go_on = often[context[some]] & (near != START) & (far != OTHER) & (far != UNSEEN)
        return np.where(go_on, context[some] * np.int64(width) + far, -1)

    for at in batches(len(symbols), two_back, BATCH):
        longer = context[at].astype(np.int64)
        for k in range(1, depth):
            known = (before[k][at] != OTHER) & (before[k][at] != UNSEEN)
            at, longer = at[known], longer[known]
            if not len(at):
                break
            longer, _ = grouped(longer * width + before[k][at])
            n = np.bincount(longer[train[at]], minlength=int(longer.max()) + 1)
            share, sums = counted(chance[at], longer, symbols[at].astype(np.int64), train[at], n, least)
            retained, left = judged(n, *sums)
            hit = np.flatnonzero(retained[longer])
            chance[at[hit]] = share[hit] + left[longer[hit]] * chance[at[hit]]
            go_on = (n[longer] >= least) & (before[k][at] != START)
            at, longer = at[go_on], longer[go_on]
    return chance


def judged(
    n: np.ndarray, kinds: np.ndarray, inside: np.ndarray, share: np.ndarray, gain: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Whether the counts after each context differ from the suffix's distribution by more than chance, and the mass
    left to the suffix. ``gain`` is of the next symbols that count: ``kinds`` of them, ``inside`` occurrences of ``n``,
    and ``share`` of the suffix's mass."""
    rest, rest_share = n - inside, 1 - share
    with np.errstate(divide="ignore", invalid="ignore"):
        more = np.where((rest > 0) & (rest_share > 0), rest * np.log(rest / n / rest_share), 0.0)
        left = 1 - (inside - DISCOUNT * kinds) / n
    return (kinds > 0) & (2 * (gain + more) > kinds + 4 * np.sqrt(2 * kinds) + 10), left


SUMS = "bucket long, block long, texts binary, sums binary, doc_ids array<string>, facts binary"


def summed(model: Tree, buckets: int, top: int, least: int, depth: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Log probabilities of the places of a bucket, summed by text; facts of texts pass through."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows[rows.facts.notna()][["bucket", "block", "doc_ids", "facts"]].assign(texts=None, sums=None)
        cells = [c.split()[0] for c in SUMS.split(", ")]
        rows = rows[rows.facts.isna()].sort_values("block")
        if not len(rows):
            return own[cells]
        total, at = int(rows.n.sum()), 0
        columns = [np.empty(total, np.int32 if top < 2**31 else np.int64) for _ in range(depth + 1)]
        chance, train = np.empty(total), np.empty(total, bool)
        for row in rows.itertuples():
            here = slice(at, at + row.n)
            at += row.n
            for k, place in enumerate(np.split(unpacked(row.places, np.uint8), depth + 1)):
                columns[k][here] = whole(place) if k != 1 else whole(place) * buckets + (row.bucket + FIRST) % buckets
            chance[here] = model.single(whole(unpacked(row.counts, np.uint8)))[grouped(columns[0][here])[0]]
            train[here] = unpacked(row.train, bool)
        chance = refined(chance, train, columns, least, depth, buckets)
        found, at = [], 0
        for row in rows.itertuples():
            texts = np.cumsum(unpacked(row.texts, np.int32))
            begins = np.flatnonzero(np.diff(texts, prepend=-1))
            sums = np.add.reduceat(np.log10(chance[at : at + row.n]), begins)
            at += row.n
            found.append((row.bucket, row.block, packed(texts[begins].astype(np.int32)), packed(sums), None, None))
        out = pd.DataFrame(found, columns=["bucket", "block", "texts", "sums", "doc_ids", "facts"])
        return pd.concat([own[cells], out[cells]]) if len(own) else out[cells]

    return run


SCORES = (
    "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def finished(tokens: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows[rows.facts.notna()].iloc[0]
        facts = unpacked(own.facts, np.dtype(FACTS))
        score = facts["rest"].copy()
        for row in rows[rows.facts.isna()].sort_values("bucket").itertuples():
            score[unpacked(row.texts, np.int32)] += unpacked(row.sums, np.float64)
        values = (own.doc_ids, ~facts["train"], facts["size"], facts["known"], tokens, facts["base"], score)
        return pd.DataFrame(dict(zip([part.split()[0] for part in SCORES.split(", ")], values)))

    return run


def scores(docs: DataFrame, train: Column, text: str = "text", least: int = LEAST, depth: int = DEPTH) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``."""
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    buckets = int(chars) // BUCKET_CHARS + 1
    rows = handed_over(blocks(docs, train, text, buckets), "blocks")
    asked = rows.where(F.col("words").isNotNull()).select("bucket", "block", "numbers", "words", "counts")
    words = handed_over(split_even(asked, "bucket").groupBy("bucket").applyInPandas(count_words(buckets), WORDS), "words")
    sums = words.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "kinds", "once", "twice")], F.coalesce(F.max("top"), F.lit(0))).first()
    *totals, top = (int(x) for x in sums)
    model = Tree(*totals)
    texts = rows.where(F.col("words").isNull()).select("block", "doc_ids", "train", "sizes", "numbers")
    facts = words.select("block", "numbers", "counts", "symbols")
    dealt = split_even(texts, "block").groupBy("block").cogroup(split_even(facts, "block").groupBy("block"))
    places = dealt.applyInPandas(placed(model, buckets, depth), PLACES)
    logs = split_even(places, "bucket").groupBy("bucket").applyInPandas(summed(model, buckets, top, least, depth), SUMS)
    scored = split_even(logs, "block").groupBy("block").applyInPandas(finished(model.tokens), SCORES)
    return scored.withColumn("doc_id", F.col("doc_id").cast("long"))
