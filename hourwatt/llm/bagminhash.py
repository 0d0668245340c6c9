"""Near-duplicates by BagMinHash: weighted-Jaccard signatures, banding, exact verification.

A text is the multiset of its runs of five lower-cased words (of all its words if it has fewer).
Every shingle has Poisson processes over its discretised weight: one per octave [0,1), [1,2),
[2,4), ...; points of an octave that a count fills in part are kept by their position in it. A
point arrives at a time and in one of the signature's components, and the earliest point of a
component is its value, so two components agree with the probability of the weighted Jaccard
similarity. Points later than a horizon that leaves no component empty are never drawn.

Links: texts that agree in a band are compared with that band's leader (another one in each band);
a verified overlap of at least the threshold links them. Then the members of a bucket that are not
yet linked alike are compared with all its members, block by block, through an inverted index of
the block's shingles; only links that join two classes of the block leave the task, so a bucket of
any size loses no link and no list of pairs is made. Equal texts are one node; classes are
connected components of nodes.

Null texts count as empty. Texts without a word are linked to nothing, not even to each other. The
class id is the smallest doc_id of the class (null if all are null). Repeated rows share a class;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from hourwatt.llm.common import WORD, fresh, handed_over, task_cache

SHINGLE, BANDS, ROWS, THRESHOLD = 5, 24, 5, 0.8
SIZE = BANDS * ROWS
LEAST_ESTIMATE = 0.55  # below the threshold by 6.8 standard deviations of an estimate of 0.8
BLOCK = 2048  # nodes of a bucket compared at once

_WORDS = re.compile(WORD)
_GOLD, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str, known: dict) -> np.ndarray:
    out = []
    for w in _WORDS.findall(text.lower()):
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"))
        out.append(h)
    return np.array(out, dtype=np.uint64)


def shingles(text: str, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order, and how often each occurs."""
    words = word_hashes(text, known)
    n = max(len(words) - SHINGLE + 1, min(len(words), 1))
    width = min(SHINGLE, len(words))
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = mixed(out ^ words[k : k + n])
    return np.unique(out, return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets; 0 if either is empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    either = int(a[1].sum() + b[1].sum()) - both
    return both / either if both else 0.0


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], size: int = SIZE, reach: float = 8.0) -> np.ndarray:
    """A row of ``size`` 32-bit values for each non-empty multiset, all drawn side by side."""
    n = len(sets)
    best = np.full(n * size, np.iinfo(np.uint64).max, dtype=np.uint64)
    doc = np.repeat(np.arange(n), [len(s[0]) for s in sets])
    key = np.concatenate([s[0] for s in sets])
    count = np.concatenate([s[1] for s in sets]).astype(np.float64)
    total = np.array([s[1].sum() for s in sets], dtype=np.float64)
    horizon = (np.log(size) + reach) / total
    octave, low = 0, 0.0
    while len(doc):
        wide = max(low, 1.0)
        d, seed, c = doc, mixed(key * np.uint64(2 * octave + 1) + np.uint64(octave)), count
        t = np.zeros(len(d))
        step = 0
        while len(d):
            step += 1
            draw = mixed(seed + np.uint64(step * int(_GOLD) % 2**64))
            t = t - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (size * wide)
            live = t < horizon[d]
            d, seed, c, t, draw = d[live], seed[live], c[live], t[live], draw[live]
            point = mixed(draw ^ _B)
            spot = low + (point >> np.uint64(40)).astype(np.float64) * (wide * 2.0**-24)
            fits = spot < c
            where = (mixed(point) % np.uint64(size)).astype(np.int64) + d * size
            value = (t.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (
                point & np.uint64(0xFFFFFFFF)
            )
            np.minimum.at(best, where[fits], value[fits])
        low = low + wide
        octave += 1
        more = count > low
        doc, key, count = doc[more], key[more], count[more]
    best = best.reshape(n, size)
    out = (best & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    short = np.flatnonzero((best == np.iinfo(np.uint64).max).any(axis=1))
    if len(short):
        out[short] = signatures([sets[i] for i in short], size, reach * 2)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        out = mixed(out ^ mixed(parts[:, :, k]))
    return out.view(np.int64)


def node_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def signed(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, node, bands, signature) per row; both are empty where there is no word."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = task_cache("words", "bagminhash")
        for big in batches:
            for at in range(0, len(big), 256):
                batch = big.iloc[at : at + 256]
                if len(known) > 500_000:
                    known.clear()
                first: dict[bytes, int] = {}
                sets, spot = [], []
                for node, t in zip(batch.node, batch.text):
                    if node not in first:
                        found = shingles(t, known)
                        first[node] = len(sets) if len(found[0]) else -1
                        if len(found[0]):
                            sets.append(found)
                    spot.append(first[node])
                sig = signatures(sets) if sets else np.zeros((0, SIZE), np.uint32)
                keys = band_keys(sig) if sets else np.zeros((0, BANDS), np.int64)
                yield pd.DataFrame(
                    {
                        "doc_id": batch.doc_id.array,
                        "node": batch.node.array,
                        "bands": pd.Series([keys[i] if i >= 0 else [] for i in spot], dtype=object).array,
                        "signature": pd.Series([sig[i].tobytes() if i >= 0 else b"" for i in spot], dtype=object).array,
                    }
                )

    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), node_key(value).alias("node"), value.alias("text"))
    out = rows.mapInPandas(run, "doc_id string, node binary, bands array<long>, signature binary")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def _agreement(a: pd.Series, b: pd.Series) -> np.ndarray:
    if not len(a):
        return np.zeros(0)
    x = np.frombuffer(b"".join(a), np.uint32).reshape(len(a), SIZE)
    y = np.frombuffer(b"".join(b), np.uint32).reshape(len(b), SIZE)
    return (x == y).mean(axis=1)


@F.pandas_udf(T.DoubleType())
def estimate(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(_agreement(a, b))


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict = {}
    kept: dict[str, tuple] = {}

    def sets(t: str) -> tuple:
        if t not in kept:
            if len(kept) > 200:
                kept.clear()
            kept[t] = shingles(t, known)
        return kept[t]

    return pd.Series([overlap(sets(x), sets(y)) for x, y in zip(a, b)], dtype="float64")


def star_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each member of a bucket with the bucket's leader, each pair once."""
    leaders = members.groupBy("key").agg(F.min_by("node", F.xxhash64("node", "key")).alias("leader"))
    return (
        members.join(leaders, "key")
        .where(F.col("node") != F.col("leader"))
        .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
        .distinct()
    )


def verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose multisets overlap enough; the signature rules out most others beforehand."""
    likely = handed_over(
        pairs.join(nodes.select(F.col("node").alias("a"), F.col("signature").alias("s")), "a")
        .join(nodes.select(F.col("node").alias("b"), F.col("signature").alias("t")), "b")
        .where(estimate("s", "t") >= LEAST_ESTIMATE)
        .select("a", "b"),
        "bagminhash-likely",
    )
    both = (
        likely.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    )
    return both.where(similarity("x", "y") >= threshold).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link; root is the smallest node that it reaches.

    Alternates two steps until nothing changes: larger neighbours move to the smallest one, then
    smaller neighbours do. The links of a round are written to the shared folder.
    """
    now = handed_over(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("u") != F.col("v")).distinct(),
        "components",
    )
    state = _mark(now)
    while True:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = handed_over(low.select("u", F.col("m").alias("v")).union(rest).distinct(), "components")
        after = _mark(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v")).distinct()


def _mark(links: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    return tuple(links.agg(F.count("*"), F.bit_xor(mark), F.sum(mark.cast("decimal(38,0)"))).first())


class BlockIndex:
    """Shingles of a block's texts: which texts hold a shingle, and how often."""

    def __init__(self, sets: list[tuple[np.ndarray, np.ndarray]]):
        self.total = np.array([s[1].sum() for s in sets], dtype=np.int64)
        hashes = np.concatenate([s[0] for s in sets])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.owner = np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets])[order]
        self.count = np.concatenate([s[1] for s in sets])[order]

    def overlaps(self, a: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Weighted Jaccard similarity of ``a`` with every text of the block."""
        low, high = (np.searchsorted(self.hashes, a[0], side) for side in ("left", "right"))
        sizes = high - low
        n = int(sizes.sum())
        at = np.arange(n) + np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        shared = np.minimum(self.count[at], np.repeat(a[1], sizes))
        both = np.bincount(self.owner[at], weights=shared, minlength=len(self.total))
        return both / (self.total + a[1].sum() - both)


def block_links(
    asks: list[int], roots: list, bands: np.ndarray, band: int, sets: list[tuple[np.ndarray, np.ndarray]], threshold: float
) -> list[tuple[int, int]]:
    """Links between rows of one block that join what ``roots`` and earlier links leave apart.

    A pair that agrees in several bands is compared in the first of them.
    """
    _, label = np.unique(np.array(roots, dtype=object), return_inverse=True)
    index, out = BlockIndex(sets), []
    for q in asks:
        apart = label != label[q]
        if not apart.any():
            continue
        apart &= (bands == bands[q]).argmax(axis=1) == band
        if not apart.any():
            continue
        for i in np.flatnonzero(apart & (index.overlaps(sets[q]) >= threshold)):
            if label[i] != label[q]:
                out.append((q, int(i)))
                label[label == label[i]] = label[q]
    return out


def residual_links(members: DataFrame, links: DataFrame, nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b): verified links that the stars left out.

    Buckets of two are complete. Of the others, each row outside the bucket's largest star is
    compared with all rows of the bucket, a block of askers and a block of rows in a task.
    """
    both = links.union(links.select("b", "a")).toDF("node", "other")
    roots = both.groupBy("node").agg(F.min(F.least("node", "other")).alias("root"))
    rows = members.join(roots, "node", "left").select("band", "key", "node", F.coalesce("root", "node").alias("root"))
    sizes = rows.groupBy("band", "key", "root").agg(F.count("*").alias("n"))
    buckets = (
        sizes.groupBy("band", "key")
        .agg(F.sum("n").alias("total"), F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("kinds"))
        .where((F.col("kinds") > 1) & (F.col("total") > 2))
        .select("band", "key", "total", F.col("top.root").alias("top"), (F.col("total") - F.col("top.n")).alias("others"))
    )
    # Of buckets with the same members only the one of the first band is needed.
    mark = F.xxhash64("node")
    prints = rows.groupBy("band", "key").agg(F.count("*").alias("n"), F.bit_xor(mark).alias("x"), F.sum(mark.cast("decimal(38,0)")).alias("s"))
    once = prints.groupBy("n", "x", "s").agg(F.min(F.struct("band", "key")).alias("k")).select("k.*")
    rows = rows.join(buckets.join(once, ["band", "key"], "left_semi"), ["band", "key"])
    q_blocks = F.ceil(F.col("others") / BLOCK).cast("int")
    c_blocks = F.ceil(F.col("total") / BLOCK).cast("int")
    place = F.xxhash64("node", "key")
    outside = F.col("root") != F.col("top")
    asks = rows.where(outside).select(
        "band", "key", F.pmod(place, q_blocks).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), c_blocks - 1)).alias("cb"), F.lit(True).alias("asks"), "node", "root",
    )
    answers = rows.select(
        "band", "key", F.explode(F.sequence(F.lit(0), q_blocks - 1)).alias("qb"),
        F.pmod(place, c_blocks).cast("int").alias("cb"), F.lit(False).alias("asks"), "node", "root",
    )
    # A row that asks in the block in which it also answers comes once.
    placed = asks.union(answers).groupBy("band", "key", "qb", "cb", "node", "root").agg(F.max("asks").alias("asks"))
    full = placed.join(nodes.select("node", "bands"), "node").join(texts, "node")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        known: dict = {}
        sets = [shingles(t, known) for t in group.text]
        asking = np.flatnonzero(group.asks.to_numpy(dtype=bool)).tolist()
        found = block_links(asking, list(group.root), np.stack(group.bands.to_numpy()), int(group.band.iloc[0]), sets, threshold)
        names = group.node.to_numpy()
        rows = [(min(names[i], names[j]), max(names[i], names[j])) for i, j in found]
        return pd.DataFrame(rows, columns=["a", "b"])

    return full.groupBy("band", "key", "qb", "cb").applyInPandas(compare, "a binary, b binary").distinct()


def classes(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, node, class_id, root) for every row of ``docs``.

    ``root`` names the class, also where ids are null or repeated: its smallest node; null for wordless rows.
    """
    signs = handed_over(signed(docs, text), "bagminhash")
    worded = F.length("signature") > 0
    nodes = signs.where(worded).groupBy("node").agg(F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    spread = signs.where(worded).select(F.posexplode("bands").alias("band", "key"), "node")
    crowded = spread.groupBy("band", "key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    members = handed_over(spread.join(crowded, ["band", "key"], "left_semi").distinct(), "bagminhash-members")
    value = F.coalesce(F.col(text), F.lit(""))
    texts = handed_over(
        docs.select(node_key(value).alias("node"), value.alias("text"))
        .join(members.select("node").distinct(), "node", "left_semi")
        .groupBy("node")
        .agg(F.first("text").alias("text")),
        "bagminhash-texts",
    )
    near = nodes.join(members.select("node").distinct(), "node", "left_semi")
    near = handed_over(near, "bagminhash-nodes")
    links = handed_over(verified(star_pairs(members), near, texts, threshold), "bagminhash-stars")
    rest = handed_over(residual_links(members, links, near, texts, threshold), "bagminhash-rest")
    roots = components(links.union(rest))
    per_node = signs.groupBy("node").agg(F.min("doc_id").alias("low"), F.max(F.length("signature")).alias("n"))
    named = per_node.where("n > 0").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    class_ids = named.groupBy("root").agg(F.min("low").alias("class_id"))
    final = named.join(class_ids, "root").select("node", "class_id", "root")
    rows = signs.where(worded).select("doc_id", "node").join(final, "node").select("doc_id", "node", "class_id", "root")
    blank = signs.where(F.length("signature") == 0)
    return rows.union(blank.select("doc_id", "node", F.col("doc_id").alias("class_id"), F.lit(None).cast("binary").alias("root")))


def one_per_class(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: of each class one with the smallest doc_id, wordless rows all."""
    found = handed_over(classes(docs, text, threshold), "classes")
    key, mark = fresh(docs, "node"), fresh(docs, "mark")
    blank = F.coalesce(F.length(F.regexp_extract(F.coalesce(F.col(text), F.lit("")), WORD, 0)), F.lit(0)) == 0
    low = F.min(F.struct(F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)), F.col("node")))
    stays = found.where(F.col("root").isNotNull()).groupBy("root").agg(low.alias("best")).select(F.col("best.col1").alias(mark), F.col("best.node").alias(key))
    keyed = docs.withColumn(key, node_key(F.coalesce(F.col(text), F.lit(""))))
    keyed = keyed.withColumn(mark, F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)))
    rank = fresh(keyed, "rank")
    first = F.row_number().over(Window.partitionBy(key, mark).orderBy(*[c for c, kind in docs.dtypes if kind in ("string", "bigint", "int")] or [key]))
    kept = keyed.where(~blank).join(stays, [key, mark], "left_semi").withColumn(rank, first).where(F.col(rank) == 1)
    return kept.select(*docs.columns).union(docs.where(blank).select(*docs.columns))
