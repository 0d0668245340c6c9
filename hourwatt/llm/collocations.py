"""Phrase collocations by partitioned mining (SON).

Texts are split into pieces and words once, and kept as blocks of word numbers; each block belongs to one
of a fixed number of shards. For phrases of one word, then two, three and four: every shard counts all its phrases and
keeps those that reach the shard's share of the support (a phrase that reaches the support somewhere reaches that share in
at least one shard); the union of what the shards keep is counted exactly over all blocks. A longer phrase is
looked at only where both phrases one word shorter have the support, so the blocks shrink from level to level.

A shard has many blocks and is counted by many tasks, so nothing grows with the corpus in one task; the number of shards is
a parameter that stays fixed, so the local support stays useful at any size. A block sends one row per distinct phrase, so a phrase
that makes up a third of all text is as many rows as there are blocks. Both phases work on one shuffle. Blocks number their own words and phrases, so their
streams stay small.

Null texts are empty and a null language is ``und``. Repeated rows count each time. Rows with equal score and count
are ordered by the phrase's UTF-8 bytes. An empty table, or languages without a phrase that reaches the support, give
no rows. Only text and language are read, whatever other columns are called. One text is held whole by a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourwatt.llm.common import Scratch, split_even

SUPPORT, LONGEST, SHARDS, COVERED, BEST = 30, 4, 8, 80, 2000
BLOCK_WORDS, SLICE_BYTES = 1 << 20, 1 << 22
_PART = 1 << 20  # blocks of one task at most
_SEPARATOR = 10
# The characters that end a piece; A to Z are lowered, all other bytes stay.
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[ord("A") : ord("Z") + 1] += 32
_TABLE[list(b".,;:!?\n\x0b\x0c\r")] = _SEPARATOR

BLOCKS = "block long, lang string, n long, ids binary, words array<string>, counts array<int>"
STREAM = "block long, least long, ids binary, words binary, grams binary, phrases binary"
PARTIAL = "prefix long, word long, block long, least long, c long"


def coded(data: bytes, known: dict[bytes, int]) -> np.ndarray:
    """Numbers of the words in order, -1 for the end of a piece; new words are added to ``known``."""
    raw = _TABLE[np.frombuffer(data, np.uint8)]
    blank, ends = (raw == 32) | (raw == 9), raw == _SEPARATOR
    word = ~(blank | ends)
    first = ends | word
    first[1:] &= ends[1:] | ~word[:-1]
    shown = raw[~blank]
    starts = np.append(np.flatnonzero(first[~blank]), len(shown)).astype(np.int32)
    tokens = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(shown)])
    found = tokens.dictionary_encode()
    numbers = [-1 if t == b"\n" else known.setdefault(t, len(known)) for t in found.dictionary.to_pylist()]
    return np.array(numbers, np.int32)[found.indices.to_numpy()] if numbers else np.zeros(0, np.int32)


def blocks(docs: DataFrame, text: str, lang: str, shards: int, size: int = BLOCK_WORDS) -> DataFrame:
    """Texts of one language as word numbers, with the block's words and their counts; ``block % shards`` is its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        known: dict[str, dict[bytes, int]] = {}
        held: dict[str, list[np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            for name, streams in held.items():
                ids = np.concatenate(streams)
                counts = np.bincount(ids[ids >= 0], minlength=len(known[name])).astype(np.int32)
                words = [w.decode("utf-8", "replace") for w in known[name]]
                number = (part * _PART + made) * shards + (part + made) % shards
                made += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]), pa.array([name]), pa.array([int(counts.sum())]), pa.array([_packed(ids)], pa.binary()),
                        pa.array([words], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int32())),
                    ],
                    ["block", "lang", "n", "ids", "words", "counts"],
                )
            held.clear()
            known.clear()

        waiting = 0
        for batch in batches:
            names = batch.column("lang").dictionary_encode()
            where, texts = names.indices.to_numpy(), batch.column("text").cast(pa.large_binary())
            slot = np.cumsum(pc.binary_length(texts).to_numpy()) // SLICE_BYTES
            for cut in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(slot)) + 1):
                for k in np.unique(where[cut]):
                    name = names.dictionary[int(k)].as_py()
                    some = texts.take(pa.array(cut[where[cut] == k])).to_pylist()
                    ids = coded(b"\n".join([*some, b""]), known.setdefault(name, {}))
                    held.setdefault(name, []).append(ids)
                    waiting += len(ids)
                if waiting >= size:
                    yield from flush()
                    waiting = 0
        yield from flush()

    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, BLOCKS)


def mined(partial: DataFrame, keys: list[str], shards: int, support: int) -> DataFrame:
    """``partial`` (counts by block) without the rows of other phrases than those with the support; ``f`` and ``id`` added.

    One exchange, by phrase, and one sort serve all steps. Every shard's counts: phrases that reach a shard's share
    of the support are the union of candidates; a candidate's count over all blocks is ``f``, exact; ``id`` is a number
    for each phrase that is left. One task sees and writes all rows of a phrase, one per block.
    """
    dealt = split_even(partial, *keys).withColumns(
        {"_shard": F.pmod("block", F.lit(shards)), "_row": F.monotonically_increasing_id()}
    )
    in_shard, everywhere = Window.partitionBy(*keys, "_shard"), Window.partitionBy(*keys)
    local = dealt.withColumn("_local", F.sum("c").over(in_shard))
    candidate = F.max(F.col("_local") >= F.col("least")).over(everywhere)
    exact = local.withColumns(
        {"_candidate": candidate, "f": F.sum("c").over(everywhere), "id": F.min("_row").over(everywhere)}
    )
    return exact.where(F.col("_candidate") & (F.col("f") >= support)).drop("_shard", "_row", "_local", "_candidate")


def _runs(keep: np.ndarray, *streams: np.ndarray) -> list[np.ndarray]:
    """The kept positions, with -1 wherever some in between are left out."""
    at = np.flatnonzero(keep)
    gaps = np.flatnonzero(np.diff(at) > 1) + 1
    return [np.insert(stream[at], gaps, -1) for stream in streams]


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.compress(numbers.tobytes(), 1)


def _stream_row(row: dict, ids: np.ndarray, words: np.ndarray, grams: np.ndarray | None, phrases: np.ndarray | None) -> pa.RecordBatch:
    """``grams`` and ``phrases`` are left empty where they are the same as ``ids`` and ``words``."""
    streams = (ids.astype(np.int32), words, None if grams is None else grams.astype(np.int32), phrases)
    binary = [pa.array([b"" if x is None else _packed(x)], pa.binary()) for x in streams]
    numbers = [pa.array([row[c]], pa.int64()) for c in ("block", "least")]
    return pa.RecordBatch.from_arrays([*numbers, *binary], ["block", "least", "ids", "words", "grams", "phrases"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one: numbers, and arrays of what the columns hold."""
    kinds = {"ids": np.int32, "words": np.int64, "grams": np.int32, "phrases": np.int64}
    same = {"grams": "ids", "phrases": "words"}
    for batch in batches:
        for i in range(len(batch)):
            row = {}
            for name, column in zip(batch.schema.names, batch.columns):
                cell = column[i]
                if pa.types.is_list(column.type):
                    row[name] = cell.values.to_numpy()
                elif name in kinds:
                    data = cell.as_py()
                    row[name] = np.frombuffer(zstandard.decompress(data), kinds[name]) if data else row[same[name]]
                else:
                    row[name] = cell.as_py()
            yield row


def word_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their frequent words alone, numbered in the block (``words`` has the numbers of the corpus);
    runs of at least two such words stay."""
    for row in _rows(batches):
        words, place = np.unique(row["id"], return_inverse=True)
        table = np.full(int(row["ids"].max(initial=0)) + 2, -1, np.int32)
        table[row["number"]] = place
        ids = table[row["ids"]]
        pair = (ids[:-1] >= 0) & (ids[1:] >= 0)
        keep = np.zeros(len(ids), bool)
        keep[:-1] |= pair
        keep[1:] |= pair
        if keep.any():
            (ids,) = _runs(keep, ids)
            yield _stream_row(row, ids, words, None, None)


def phrases_of(length: int):
    """Counts of the phrases of ``length`` words in each block: (number of the first words, last word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids, grams = row["ids"], row["grams"]
            at = np.flatnonzero((grams[:-1] >= 0) & (grams[1:] >= 0))
            keys, c = np.unique(grams[at].astype(np.int64) << 32 | ids[at + length - 1], return_counts=True)
            for a in range(0, len(keys), 200_000):
                some = keys[a : a + 200_000]
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["phrases"][some >> 32]), pa.array(row["words"][some & 0xFFFFFFFF]),
                        pa.array(np.full(n, row["block"])), pa.array(np.full(n, row["least"])), pa.array(c[a : a + 200_000]),
                    ],
                    ["prefix", "word", "block", "least", "c"],
                )

    return run


def gram_stream(length: int):
    """Blocks with the frequent phrases of ``length`` words in place of shorter ones; runs of two such stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids, grams = row["ids"], row["grams"]
            phrases, place = np.unique(row["id"], return_inverse=True)
            first, last = np.searchsorted(row["phrases"], row["prefix"]), np.searchsorted(row["words"], row["word"])
            keys = first << 32 | last
            order = np.argsort(keys)
            keys, place = keys[order], place[order]
            n = len(ids) - length + 1  # places where a phrase of that length can begin
            mine = grams[:n].astype(np.int64) << 32 | (ids[length - 1 :].astype(np.int64) & 0xFFFFFFFF)
            found = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
            new = np.full(len(ids), -1, np.int32)
            new[:n] = np.where(keys[found] == mine, place[found], -1)
            two = np.flatnonzero((new[:-1] >= 0) & (new[1:] >= 0))
            keep = np.zeros(len(ids), bool)
            for k in range(length + 1):
                keep[two + k] = True
            if len(two):
                ids, new = _runs(keep, ids, new)
                yield _stream_row(row, ids, row["words"], new, phrases)

    return run


def frequent_phrases(
    docs: DataFrame, scratch: Scratch, text: str = "text", lang: str = "lang", support: int = SUPPORT,
    longest: int = LONGEST, shards: int = SHARDS, size: int = BLOCK_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """(lang, words, f) of all phrases of up to ``longest`` words with the support; (lang, n) of all words."""
    kept = scratch.keep(blocks(docs, text, lang, shards, size))
    shard = F.pmod("block", F.lit(shards))
    sizes = kept.groupBy("lang", shard.alias("shard")).agg(F.sum("n").alias("part"))
    totals = sizes.groupBy("lang").agg(F.sum("part").alias("n"))
    # The shard's share of the support, rounded up in whole numbers.
    share = F.expr(f"cast((cast({support} as decimal(38, 0)) * part + n - 1) div n as long)")
    least = sizes.join(totals.where("n > 0"), "lang").select("lang", "shard", share.alias("least"))
    known = kept.withColumn("shard", shard).join(least, ["lang", "shard"])

    words = known.select("block", "lang", "least", F.posexplode(F.arrays_zip("words", "counts")).alias("number", "_w"))
    words = words.select("block", "lang", "least", "number", F.col("_w.words").alias("word"), F.col("_w.counts").cast("long").alias("c"))
    rows = scratch.keep(mined(words, ["lang", "word"], shards, support).drop("c", "least"))
    found = rows.select("lang", "word", "f", "id").distinct()
    phrases = [scratch.keep(found.select("lang", F.array("word").alias("words"), "f", "id"))]
    single = phrases[0].select(F.col("id").alias("word"), F.col("words")[0].alias("_text"))
    places = rows.groupBy("block").agg(F.collect_list(F.struct("number", "id")).alias("_m"))
    joined = known.select("block", "least", "ids").join(places, "block")
    stream = scratch.keep(joined.select("block", "least", "ids", "_m.number", "_m.id").mapInArrow(word_stream, STREAM))

    for length in range(2, longest + 1):
        counts = stream.mapInArrow(phrases_of(length), PARTIAL)
        rows = scratch.keep(mined(counts, ["prefix", "word"], shards, support).drop("c", "least"))
        before = phrases[-1].select("lang", "words", F.col("id").alias("prefix"))
        found = rows.select("prefix", "word", "f", "id").distinct().join(before, "prefix").join(single, "word")
        phrases.append(scratch.keep(found.select("lang", F.concat("words", F.array("_text")).alias("words"), "f", "id")))
        if length < longest:
            places = rows.groupBy("block").agg(F.collect_list(F.struct("prefix", "word", "id")).alias("_m"))
            joined = stream.join(places, "block").select(*stream.columns, "_m.prefix", "_m.word", "_m.id")
            stream = scratch.keep(joined.mapInArrow(gram_stream(length), STREAM))
    every = phrases[0]
    for more in phrases[1:]:
        every = every.unionByName(more)
    return every.select("lang", "words", "f"), totals


def scored(phrases: DataFrame, totals: DataFrame, covered: int = COVERED, best: int = BEST) -> DataFrame:
    """The best phrases of each language: (lang, rank, phrase, a, l, r, n, score)."""
    text = F.array_join("words", " ")
    found = phrases.select("lang", text.alias("phrase"), "words", F.col("f").alias("a"))
    several = found.where(F.size("words") > 1)
    cuts = several.select("*", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.expr("slice(words, 1, k)"), " ").alias("_left"),
        F.array_join(F.expr("slice(words, k + 1, size(words) - k)"), " ").alias("_right"),
    )
    part = found.select("lang", "phrase", "a")
    left = part.select("lang", F.col("phrase").alias("_left"), F.col("a").alias("l"))
    right = part.select("lang", F.col("phrase").alias("_right"), F.col("a").alias("r"))
    score = F.expr("cast((cast(2000000 as decimal(38, 0)) * a) div (cast(l as decimal(38, 0)) + r) as long)")
    least = (
        cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"])
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_cut"))
    )
    inside = several.where(F.size("words") > 2).select(
        "lang", F.col("a").alias("longer"),
        F.explode(F.expr(
            "flatten(transform(sequence(2, size(words) - 1),"
            " m -> transform(sequence(1, size(words) - m + 1), i -> array_join(slice(words, i, m), ' '))))"
        )).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    exact = "decimal(38, 0)"
    drop = F.col("longer").cast(exact) * 100 >= F.col("a").cast(exact) * covered
    kept = least.join(inside, ["lang", "phrase"], "left").where(~F.coalesce(drop, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("_cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score"
    )


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, longest: int = LONGEST,
    shards: int = SHARDS, covered: int = COVERED, best: int = BEST, size: int = BLOCK_WORDS,
) -> DataFrame:
    """The ``best`` phrases of two words and more of each language; see the module for the rules."""
    scratch = Scratch(docs.sparkSession, "collocations")
    phrases, totals = frequent_phrases(docs, scratch, text, lang, support, longest, shards, size)
    return scratch.close(scored(phrases, totals, covered, best), "collocations-result")
