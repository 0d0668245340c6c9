"""Encoding with a byte-level public tokenizer inside tasks: each distinct stretch of text once.

Such a vocabulary's rule never lets a token run from a visible character into the blank after it, so
a text may be cut before every blank or line end that follows a letter or visible ASCII sign, and the ids
of the stretches in order are the ids of the text. A stretch of Latin letters, digits and ASCII signs
is cut further into the rule's own runs, which go to the library's merge model in the byte alphabet; any
other stretch (apostrophes, special tokens, other scripts) goes through the whole of the library.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hourwatt.llm.bpe import packed, tokenizer
from hourwatt.llm.common import task_cache

KEPT, LONGEST = 500_000, 64  # stretches, and runs, that a worker keeps; characters of one that is kept
_CUT = "\x01"  # in no stretch that it is used on
# Stretches that the rule splits into letters, digits and other signs, with the blank before them.
_PLAIN = r"^[ \n]?[!-&(-~À-ÖØ-öø-ſ]+$"
_RUN = r"(\n| ?[A-Za-zÀ-ÖØ-öø-ſ]+| ?[0-9]+| ?[^ \nA-Za-z0-9À-ÖØ-öø-ſ]+)"
# The byte alphabet: visible Latin-1 characters stand for themselves, other bytes are numbered from 256 on.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_SELF)))}
_BLANK = {" ": chr(_ALPHABET[32]), "\n": chr(_ALPHABET[10])}


def _spelled(run: str) -> str:
    """A run in the byte alphabet."""
    if run.isascii():  # visible but for its first character
        return _BLANK[run[0]] + run[1:] if run[0] in _BLANK else run
    return run.encode().decode("latin-1").translate(_ALPHABET)


def _kept(name: str) -> dict[str, bytes]:
    memo = task_cache(name, "ids")
    if len(memo) > KEPT:
        memo.clear()
    return memo


def _by_runs(path: str, stretches: pa.Array) -> list[bytes]:
    """Packed ids of plain stretches: their distinct runs go to the merge model."""
    lists = pc.split_pattern(pc.replace_substring_regex(stretches, _RUN, rf"\1{_CUT}"), _CUT)
    runs = lists.flatten().dictionary_encode()
    names = runs.dictionary.to_pylist()
    memo, model = _kept(f"byte runs {path}"), tokenizer(path).model
    memo[""] = b""
    for name in [n for n in names if n not in memo]:
        memo[name] = packed([t.id for t in model.tokenize(_spelled(name))])
    ids = [memo[n] for n in names]
    parts = list(map(ids.__getitem__, runs.indices.to_numpy().tolist()))
    ends = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
    return [b"".join(parts[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def _learn(path: str, stretches: pa.Array) -> list[bytes]:
    """Packed ids of distinct stretches."""
    short = pc.less_equal(pc.utf8_length(stretches), LONGEST)
    plain = pc.and_(short, pc.match_substring_regex(stretches, _PLAIN))
    plain = pc.and_(plain, pc.invert(pc.match_substring(stretches, "<|"))).to_numpy(zero_copy_only=False)
    out: list[bytes] = [b""] * len(stretches)
    for i, ids in zip(np.flatnonzero(plain).tolist(), _by_runs(path, stretches.filter(pa.array(plain)))):
        out[i] = ids
    rest = np.flatnonzero(~plain)
    for at in range(0, len(rest), 1024):
        some = rest[at : at + 1024]
        texts = stretches.take(pa.array(some)).to_pylist()
        for i, found in zip(some.tolist(), tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)):
            out[i] = packed(found.ids)
    return out


def stretches_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The stretches of all texts in order, and where each text's begin.

    Cut before a blank or line end that follows a visible ASCII sign or a two-byte Latin letter.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    begins = offsets - offsets[0]
    after = (raw > 32) & (raw < 127)
    if len(raw) > 1:
        first, second = raw[:-1], raw[1:]
        # Lead bytes of U+00C0 to U+017F, of which the signs of multiplication and division are no letters.
        after[1:] |= (first >= 0xC3) & (first <= 0xC5) & (second >= 0x80) & ~((first == 0xC3) & ((second == 0x97) | (second == 0xB7)))
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = after[:-1] & ((raw[1:] == 32) | (raw[1:] == 10))
    cut[begins] = True
    ends = np.flatnonzero(cut)
    found = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(raw)])
    return found, np.searchsorted(ends, begins)


def encoded(path: str, texts: pa.Array) -> Iterator[np.ndarray]:
    """Ids of each text; nulls count as empty."""
    if not len(texts):
        return
    stretches, begins = stretches_of(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat = stretches.dictionary_encode()
    names = flat.dictionary.to_pylist()
    memo = _kept(f"byte stretches {path}")
    ids = list(map(memo.get, names))
    new = [i for i, found in enumerate(ids) if found is None]
    for i, found in zip(new, _learn(path, flat.dictionary.take(pa.array(new, pa.int64())))):
        ids[i] = found
        if len(names[i]) <= LONGEST:
            memo[names[i]] = found
    parts = list(map(ids.__getitem__, flat.indices.to_numpy().tolist()))
    ends = begins.tolist()
    for a, b in zip(ends[:-1], ends[1:]):
        yield np.frombuffer(b"".join(parts[a:b]), np.uint32)
