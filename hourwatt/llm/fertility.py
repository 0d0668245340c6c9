"""Quality rules with tokeniser fertility: how well public vocabularies fit a text.

Two public vocabularies encode every word: a byte-level one gives characters per token and the
entropy of the tokens, a piece vocabulary with byte fallback gives characters per piece and the share of
byte pieces. Texts are grouped by script, language and size class; each measure has a band per
group, the quartiles over all documents widened by ``REACH`` times their distance. A text outside
a band is rejected, as is one that fails the base rules. A group that is a small share of its language leans on
the quartiles of all sizes of the language. Nothing depends on how many texts there are: a corpus and
its copies together get the verdicts that the corpus gets alone.

Null texts count as texts without words: no measure, rejected by the base rule. Repeated rows and
ties get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourwatt.llm.bpe import packed
from hourwatt.llm.common import WORD, handed_over, task_cache

MEASURES = ("chars_per_token", "chars_per_piece", "byte_share", "token_entropy")
REACH, KEPT, SLICE = 2.0, 400_000, 512
SHARE = 0.01  # a group with this share of its language has as much weight in its band as the whole language
DIGITS, EDGE = 4, 1e-9  # of rounded measures; so much beyond a band is still inside
#: Least width of a band on either side of the median, so that groups of equal texts reject nothing nearby.
LEAST_WIDTH = {"chars_per_token": 0.2, "chars_per_piece": 0.2, "byte_share": 0.02, "token_entropy": 0.05}
SYMBOLS = "[#*$%&|<>]"
# First and last code points of common scripts.
SCRIPTS = (
    ("latin", "ª", "ɏ"), ("greek", "Ͱ", "Ͽ"), ("cyrillic", "Ѐ", "ӿ"), ("hebrew", "֐", "׿"),
    ("arabic", "؀", "ۿ"), ("devanagari", "ऀ", "ॿ"), ("thai", "฀", "๿"), ("hangul", "가", "힣"),
    ("kana", "぀", "ヿ"), ("han", "一", "鿿"),
)
_ASCII_LETTERS, _ASCII = re.compile("[A-Za-z]+"), re.compile(r"[\x00-\x7f]+")
_LATIN, _BEYOND_LATIN = re.compile(f"[A-Za-z{SCRIPTS[0][1]}-{SCRIPTS[0][2]}]+"), SCRIPTS[1][1]
_SCRIPT = [(name, re.compile(f"[{a}-{b}]")) for name, a, b in SCRIPTS]


def letters(text: str) -> Counter:
    """Letters of each script."""
    rest = _ASCII_LETTERS.sub("", text)
    counts = Counter(latin=len(text) - len(rest))
    if not rest.isascii():
        rest = _ASCII.sub("", rest)
        for name, found in _SCRIPT:
            counts[name] += len(found.findall(rest))
    return counts


def script_of(text: str) -> str:
    """The script of most letters, the earlier one on a tie; ``none`` without any."""
    counts = letters(text)
    best = max(counts, key=lambda k: counts[k])
    return best if counts[best] else "none"


def _slices(offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    upto = np.concatenate([[0], np.cumsum(values)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lines = pc.split_pattern(texts, "\n")
    names = lines.flatten().dictionary_encode()
    worded = pc.match_substring_regex(names.dictionary, WORD).to_numpy(zero_copy_only=False)
    line, offsets = names.indices.to_numpy().astype(np.int64), lines.offsets.to_numpy() - lines.offsets[0].as_py()
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    keys, n = np.unique((doc << 32 | line)[worded[line]], return_counts=True)
    return np.bincount(keys >> 32, weights=n - 1, minlength=len(texts)).astype(np.int64)


def repeated_words(doc: np.ndarray, word: np.ndarray, texts: int) -> np.ndarray:
    """Words inside three-word windows that a text has twice or more."""
    inside = doc[2:] == doc[:-2]  # where a window begins
    pairs = np.unique(word[:-1] << 32 | word[1:], return_inverse=True)[1]
    threes = np.unique(pairs[:-1] << 32 | word[2:], return_inverse=True)[1]
    _, place, n = np.unique(doc[2:][inside] << 32 | threes[inside], return_inverse=True, return_counts=True)
    often = np.zeros(len(inside), bool)
    often[inside] = n[place] > 1
    covered = np.zeros(len(word), bool)
    for k in range(3):
        covered[k : k + len(often)] |= often
    return np.bincount(doc[covered], minlength=texts)


def vocabularies(byte_vocabulary: str, piece_vocabulary: str):
    """The two encoders, kept by the worker."""
    kept = task_cache("words", "fertility")
    if not kept:
        import sentencepiece
        import tiktoken

        with open(byte_vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        kept["bytes"] = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        kept["pieces"] = sentencepiece.SentencePieceProcessor(model_file=piece_vocabulary)
        model = kept["pieces"]
        kept["byte ids"] = frozenset(i for i in range(model.get_piece_size()) if model.is_byte(i))
        kept["words"] = {}
    return kept


def learned_words(kept: dict, words: list[str]) -> list[tuple[bytes, int, int, int, bool]]:
    """Of every word: its tokens, number of pieces, how many are bytes, Latin letters, whether it may have letters
    of another script."""
    memo = kept["words"]
    if len(memo) > KEPT:
        memo.clear()
    new = [w for w in words if w not in memo]
    if new:
        bytes_of, one = kept["byte ids"], kept["bytes"].encode_ordinary
        for word, found in zip(new, kept["pieces"].encode(new, num_threads=1)):
            if word.isascii() and word.isprintable():
                n_bytes, other = 0, False
            else:
                n_bytes, other = sum(map(bytes_of.__contains__, found)), max(word) >= _BEYOND_LATIN
            latin = len(word) if word.isascii() and word.isalpha() else len(word) - len(_LATIN.sub("", word))
            memo[word] = (packed(one(" " + word)), len(found), n_bytes, latin, other)
    return [memo[w] for w in words]


def entropies(doc: np.ndarray, tokens: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Entropy of each text's tokens, as a share of the largest possible one."""
    keys, times = np.unique(doc << 32 | tokens, return_counts=True)
    spread = np.bincount(keys >> 32, weights=times * np.log(times), minlength=len(n))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 1, 1.0 - spread / (n * np.log(n)), 0.0)


FACTS = (
    "doc_id long, lang string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, n_tokens long, chars_per_token double, chars_per_piece double, byte_share double,"
    " token_entropy double"
)


def measures(docs: DataFrame, text: str = "text", byte_vocabulary: str | None = None, piece_vocabulary: str | None = None) -> DataFrame:
    """A row of facts per row of ``docs``."""
    paths = (
        byte_vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"),
        piece_vocabulary or public_tokenizers.path("piece_bpe_32k.model"),
    )
    names = [part.split()[0] for part in FACTS.split(",")]

    def facts_of(kept: dict, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").cast(pa.large_string())
        n = len(texts)
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        found, word = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
        if "" in found:  # a text that begins or ends with a blank
            some = word != found.index("")
            word, doc = word[some], doc[some]
        offsets = np.searchsorted(doc, np.arange(n + 1))
        packs, pieces, from_bytes, latin, other = zip(*learned_words(kept, found)) if found else [()] * 5
        flat, size = np.frombuffer(b"".join(packs), np.uint32).astype(np.int64), np.array([len(p) // 4 for p in packs], np.int64)
        begin = np.concatenate([[0], np.cumsum(size)])
        per_word = size[word]
        at = np.repeat(begin[word] - np.concatenate([[0], np.cumsum(per_word)[:-1]])[: len(word)], per_word)
        tokens = flat[at + np.arange(len(at))]
        sums = [_slices(offsets, np.array(x, np.int64)[word]) for x in (size, pieces, from_bytes, latin, other, [len(w) for w in found])]
        n_tokens, n_pieces, n_bytes, n_latin, n_other, chars = sums
        some = (n_tokens > 0) & (n_pieces > 0)
        script = np.where(n_latin > 0, "latin", "none").astype(object)
        for i in np.flatnonzero(n_other):
            script[i] = script_of(texts[int(i)].as_py())
        share = lambda a, b: np.where(some, a / np.maximum(b, 1), 0.0)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("lang"), pa.array(script, pa.string()), pa.array(np.diff(offsets)), pa.array(chars),
                pc.count_substring_regex(texts, SYMBOLS).cast(pa.int64()), pa.array(repeated_lines(texts)),
                pa.array(repeated_words(doc, word, n)), pa.array(np.where(some, n_tokens, 0)),
                pa.array(share(chars, n_tokens)), pa.array(share(chars, n_pieces)), pa.array(share(n_bytes, n_pieces)),
                pa.array(np.where(some, entropies(np.repeat(doc, per_word), tokens, n_tokens), 0.0)),
            ],
            names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = vocabularies(*paths)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                yield facts_of(kept, batch.slice(at, SLICE))

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, FACTS)


GROUP = ["script", "lang_key"]


def quartiles(counts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, q1, q2, q3) of counted values: the least value that a quarter, a half, three quarters reach.

    A group's values are rounded, so it has a bounded number of distinct ones, however many texts.
    """
    upto = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    each = counts.groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    each = each.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    least = [F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("value"))).alias(f"q{k}") for k in (1, 2, 3)]
    return each.groupBy(*keys).agg(F.first("total").alias("total"), *least)


def bands(facts: DataFrame) -> DataFrame:
    """(script, lang_key, size_class) with low and high of each measure.

    Quartiles of the group, blended with those of its script and language over all sizes. The group's weight comes
    from its share of the language's texts, not from how many they are, so a corpus of copies has the same bands; and
    no language is ever judged by another one.
    """
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.round(m, DIGITS).alias("value")) for m in MEASURES])
    rows = facts.where("n_words >= 50").select(*GROUP, "size_class", F.inline(cells))
    counts = rows.groupBy(*GROUP, "size_class", "measure", "value").agg(F.count(F.lit(1)).alias("n"))
    own = quartiles(counts, [*GROUP, "size_class", "measure"])
    wide = quartiles(counts, [*GROUP, "measure"]).select(
        *GROUP, "measure", F.col("total").alias("all"), *[F.col(f"q{k}").alias(f"w{k}") for k in (1, 2, 3)]
    )
    share = F.col("total") / F.col("all")
    weight = share / (share + SHARE)
    q = [F.col(f"q{k}") * weight + F.col(f"w{k}") * (1 - weight) for k in (1, 2, 3)]
    least = F.create_map(*[F.lit(x) for item in LEAST_WIDTH.items() for x in item])[F.col("measure")]
    both = own.join(wide, [*GROUP, "measure"]).select(
        *GROUP, "size_class", "measure",
        F.least(q[0] - REACH * (q[2] - q[0]), q[1] - least).alias("low"),
        F.greatest(q[2] + REACH * (q[2] - q[0]), q[1] + least).alias("high"),
    )
    ends = [F.max(F.when(F.col("measure") == m, F.col(end))).alias(f"{m}_{end}") for m in MEASURES for end in ("low", "high")]
    return both.groupBy(*GROUP, "size_class").agg(*ends)


def judged(docs: DataFrame, text: str = "text", **vocabulary: str) -> DataFrame:
    """The facts of every row with ``base_failed`` and ``kept``."""
    size_class = F.when(F.col("n_tokens") < 2, 0).otherwise(F.floor(F.log2(F.greatest("n_tokens", F.lit(1)) * F.lit(1.0)))).cast("int")
    facts = handed_over(
        measures(docs, text, **vocabulary)
        .withColumn("size_class", size_class)
        .withColumn("lang_key", F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), "lang"))),
        "fertility",
    )
    out = facts.join(bands(facts), [*GROUP, "size_class"], "left")  # a row per group, which Spark broadcasts while small
    inside = F.lit(True)
    for m in MEASURES:
        value = F.round(m, DIGITS)
        inside &= F.coalesce(value.between(F.col(f"{m}_low") - EDGE, F.col(f"{m}_high") + EDGE), F.lit(True))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & inside).alias("kept"), "script", *MEASURES,
    )
