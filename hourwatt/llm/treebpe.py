"""BPE encoding by tree concatenation, and decoding.

A text is cut into halves, these into halves, down to leaves of bounded length, wherever the cut
falls. Leaves are encoded on their own. Then neighbours are joined pairwise: if neither side of a cut is
white space, a window around the cut is encoded anew and grows until it holds, on either side, a
stretch of the text with exactly the tokens that the side itself has there (or until it
reaches white space, which always separates tokens). The join takes the left side up to the
stretch, the window between, the right side from its stretch on. A merge sequence is right if each pair
of adjacent tokens is; as the stretches are shared, every adjacent pair comes from an encoding.

Texts above ``PIECE`` characters are spread over tasks piece by piece and joined per text.
Null texts count as empty: no ids, and the digest of the empty string. Repeated rows give repeated
results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourwatt.llm.bpe import learned, tokenizer, unpacked, vocabulary_path
from hourwatt.llm.common import split_even, task_cache

LEAF, PIECE, FIRST_WINDOW = 2048, 65_536, 24
# The characters that Unicode calls white space.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_TO_SPACE = str.maketrans(BLANKS, " " * len(BLANKS))

Token = tuple[int, int, int]  # id, start and end in the text


def joins_back(char: str) -> bool:
    """Whether normalising may combine this character with the one before it."""
    return char > "˿" and (unicodedata.category(char)[0] == "M" or "ᅠ" <= char <= "ᇿ")


def tokens_of(path: str, text: str, start: int, end: int) -> list[Token]:
    found = tokenizer(path).encode(text[start:end], add_special_tokens=False)
    return [(i, a + start, b + start) for i, (a, b) in zip(found.ids, found.offsets)]


@dataclass
class Part:
    """The encoding of ``text[start:end]``.

    ``head`` and ``tail`` are the tokens of the stretches that touch its ends (both the same list
    if it is one stretch), ``ids`` the ids between them.
    """

    start: int
    end: int
    head: list[Token] | None
    ids: list[int]
    tail: list[Token] | None
    solid: bool = False

    def all_ids(self) -> list[int]:
        ends = [] if self.solid else [t[0] for t in self.tail or ()]
        return [t[0] for t in self.head or ()] + self.ids + ends


def leaf(path: str, text: str, start: int, end: int) -> Part:
    words = text[start:end].translate(_TO_SPACE).split(" ")
    memo = learned(path, words)
    if len(words) == 1:
        return Part(start, end, tokens_of(path, text, start, end), [], None, True)
    head = tokens_of(path, text, start, start + len(words[0])) if words[0] else None
    tail = tokens_of(path, text, end - len(words[-1]), end) if words[-1] else None
    ids = unpacked(map(memo.__getitem__, words[1:-1]))
    return Part(start, end, head, ids, tail)


def segments(tokens: list[Token], low: int, high: int) -> dict[tuple[int, int], tuple[int, ...]]:
    """Ids by stretch, for the smallest stretches of whole tokens inside ``low`` to ``high``."""
    out: dict[tuple[int, int], tuple[int, ...]] = {}
    now: list[int] = []
    first = last = 0
    for i, a, b in tokens:
        if now and a >= last:
            if low <= first and last <= high:
                out[first, last] = tuple(now)
            now = []
        if not now:
            first = a
        now.append(i)
        last = max(last, b) if len(now) > 1 else b
    if now and low <= first and last <= high:
        out[first, last] = tuple(now)
    return out


def seam(path: str, text: str, left: list[Token], right: list[Token], start: int, cut: int, end: int) -> list[Token]:
    """Tokens of the stretch ``text[start:end]`` from those of its two sides."""
    reach = FIRST_WINDOW
    while True:
        low, high = max(start, cut - reach), min(end, cut + reach)
        while low > start and joins_back(text[low]):
            low -= 1
        while high < end and joins_back(text[high]):
            high += 1
        window = tokens_of(path, text, low, high)
        own = segments(window, low, high)
        keep = own if (low, high) == (start, end) else {
            k: v for k, v in own.items() if (low == start or k[0] > low) and (high == end or k[1] < high)
        }
        near = [t for t in left if t[2] > low]
        far = [t for t in right if t[1] < high]
        before = [k for k, v in segments(near, low + 1, cut - 1).items() if keep.get(k) == v]
        after = [k for k, v in segments(far, cut + 1, high - 1).items() if keep.get(k) == v]
        if (low == start or before) and (high == end or after):
            p = start if low == start else before[0][0]
            r = end if high == end else after[-1][0]
            if p <= r:
                middle = [t for t in window if p <= t[1] < r] if high < end else [t for t in window if t[1] >= p]
                rest = [] if high == end else [t for t in right if t[1] >= r]
                return [t for t in left if t[1] < p] * (low > start) + middle + rest
        reach *= 2


def join(path: str, text: str, a: Part, b: Part) -> Part:
    cut = a.end
    touching_a = a.head if a.solid else a.tail
    if not touching_a or not b.head:
        if a.solid and not a.head:
            return Part(a.start, b.end, None, b.ids, b.tail, b.solid) if not b.head else Part(a.start, b.end, b.head, b.ids, b.tail, b.solid)
        ids = a.ids + ([] if a.solid else [t[0] for t in a.tail or ()]) + [t[0] for t in b.head or ()] * (not b.solid) + b.ids
        if b.solid:
            return Part(a.start, b.end, a.head, ids if not a.solid else a.ids, b.head, False)
        return Part(a.start, b.end, a.head, ids, b.tail, False)
    start, end = first_of(text, cut, a.start), last_of(text, cut, b.end)
    run = seam(path, text, touching_a, b.head, start, cut, end)
    if a.solid and b.solid:
        return Part(a.start, b.end, run, [], None, True)
    if a.solid:
        return Part(a.start, b.end, run, b.ids, b.tail)
    if b.solid:
        return Part(a.start, b.end, a.head, a.ids, run)
    return Part(a.start, b.end, a.head, a.ids + [t[0] for t in run] + b.ids, b.tail)


def first_of(text: str, cut: int, least: int) -> int:
    return max(least, 1 + max(text.rfind(c, least, cut) for c in BLANKS))


def last_of(text: str, cut: int, most: int) -> int:
    return min([most, *(k for c in BLANKS if (k := text.find(c, cut, most)) >= 0)])


def encode_part(path: str, text: str, start: int, end: int, size: int = LEAF) -> Part:
    """Both halves, then their join."""
    if end - start > size:
        cut = (start + end) // 2
        while cut < end and joins_back(text[cut]):
            cut += 1
        if cut < end:
            return join(path, text, encode_part(path, text, start, cut, size), encode_part(path, text, cut, end, size))
    return leaf(path, text, start, end)


def encode(path: str, text: str, size: int = LEAF) -> list[int]:
    return encode_part(path, text, 0, len(text), size).all_ids() if text else []


def join_all(path: str, text: str, parts: list[Part]) -> list[int]:
    """Neighbours are joined level by level."""
    while len(parts) > 1:
        parts = [join(path, text, *parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0].all_ids()


def digest(path: str, ids: list[int]) -> tuple[int, str, str]:
    """Number of ids, sha256 of the ids as text, sha256 of the decoded text."""
    names = task_cache("id names", "ids")
    if not names:
        names.update({i: str(i) for i in range(tokenizer(path).get_vocab_size())})
    listed = " ".join(map(names.__getitem__, ids))
    back = tokenizer(path).decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(back.encode("utf-8")).hexdigest()


RESULT = "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trips(docs: DataFrame, text: str = "text", path: str | None = None, leaf_chars: int = LEAF, piece_chars: int = PIECE) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of ``docs``."""
    path = path or vocabulary_path()
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    is_long = F.length("text") > piece_chars

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for big in batches:
            for at in range(0, len(big), 256):
                batch = big.iloc[at : at + 256]
                got = [digest(path, encode(path, t, leaf_chars)) for t in batch.text]
                out = pd.DataFrame(got, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
                out.insert(0, "doc_id", batch.doc_id.array)
                yield out

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, doc_id, t in zip(batch.key, batch.doc_id, batch.text):
                at = 0
                while at < len(t):
                    end = min(at + piece_chars, len(t))
                    while end < len(t) and joins_back(t[end]):
                        end += 1
                    yield pd.DataFrame(
                        {"key": [key], "doc_id": [doc_id], "start": [at], "text": [t[at:end]]}
                    )
                    at = end

    def encode_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.iloc[k : k + 1]
                part = encode_part(path, row.text.iloc[0], 0, len(row.text.iloc[0]), leaf_chars)
                flat = lambda ts: None if ts is None else [x for t in ts for x in t]
                yield row.assign(head=[flat(part.head)], ids=[part.ids], tail=[flat(part.tail)], solid=part.solid)

    def concatenate(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("start")
        whole = "".join(group.text)
        parts = []
        for r in group.itertuples():
            lift = lambda ts: None if ts is None else [(int(ts[k]), int(ts[k + 1]) + r.start, int(ts[k + 2]) + r.start) for k in range(0, len(ts), 3)]  # noqa: E731, B023
            parts.append(Part(r.start, r.start + len(r.text), lift(r.head), [int(i) for i in r.ids], lift(r.tail), r.solid))
        out = pd.DataFrame([digest(path, join_all(path, whole, parts))], columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        out.insert(0, "doc_id", group.doc_id.iloc[:1].array)
        return out

    small = rows.where(~is_long).mapInPandas(short, RESULT)
    pieces = rows.where(is_long).select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    pieces = split_even(pieces.mapInPandas(cut, "key long, doc_id string, start long, text string"), "key", "start")
    encoded = pieces.mapInPandas(
        encode_pieces,
        "key long, doc_id string, start long, text string, head array<int>, ids array<int>, tail array<int>, solid boolean",
    )
    out = small.union(encoded.groupBy("key").applyInPandas(concatenate, RESULT))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
