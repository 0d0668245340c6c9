"""Encoding with a public tokenizer inside tasks: stretches between plain blanks, each encoded once.

White space separates tokens in this kind of vocabulary (it is dropped before merging), so a
text's ids are the ids of its stretches in order. Only ASCII white space is cut at; the library sees
everything else. Stretches of printable ASCII and Latin letters are runs of letters, single digits
and runs of other signs, as the vocabulary's own rule says, and each run goes to the library's merge model
in the vocabulary's byte alphabet; a stretch with an apostrophe, a special token or any other character goes
through the whole of the library.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from hourwatt.llm.common import task_cache

VOCABULARY = "word_bpe_49k.json"
KEPT = 400_000  # stretches, and as many runs, that a worker keeps
# Printable ASCII without the apostrophe, Latin letters that normalising leaves whole, and the
# runs that the vocabulary splits them into.
_PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-įı-ſ]+")
_RUNS = re.compile(r"[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")
# The byte alphabet: visible Latin-1 characters stand for themselves, other bytes are numbered from 256 on.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_SELF)))}


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def tokenizer(path: str):
    kept = task_cache("tokenizers", "ids")
    if path not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(path)
        found.no_truncation()
        found.no_padding()
        kept[path] = found
    return kept[path]


def packed(ids: list[int]) -> bytes:
    """Ids as one object that is cheap to keep and to put together with others."""
    return array("I", ids).tobytes()


def unpacked(parts: Iterable[bytes]) -> list[int]:
    out = array("I")
    out.frombytes(b"".join(parts))
    return out.tolist()


def learn(path: str, words: list[str], memo: dict[str, bytes]) -> None:
    """Packed ids of ``words`` into ``memo``."""
    runs = task_cache(f"runs {path}", "ids")
    if len(runs) > KEPT:
        runs.clear()
    model, rest = tokenizer(path).model, []
    for word in words:
        if not _PLAIN.fullmatch(word) or "<|" in word:
            rest.append(word)
            continue
        parts = _RUNS.findall(word.lower())
        for run in parts:
            if run not in runs:
                spelled = run if run.isascii() else run.encode().decode("latin-1").translate(_ALPHABET)
                runs[run] = packed([t.id for t in model.tokenize(spelled)])
        memo[word] = runs[parts[0]] if len(parts) == 1 else b"".join(map(runs.__getitem__, parts))
    for at in range(0, len(rest), 4096):
        some = rest[at : at + 4096]
        for word, found in zip(some, tokenizer(path).encode_batch_fast(some, add_special_tokens=False)):
            memo[word] = packed(found.ids)


def learned(path: str, words: list[str]) -> dict[str, bytes]:
    """Packed ids by stretch, those of ``words`` at least."""
    memo = task_cache(f"stretches {path}", "ids")
    if len(memo) > KEPT:
        memo.clear()
    memo[""] = b""
    new = set(words).difference(memo)
    if new:
        learn(path, list(new), memo)
    return memo


def encode_texts(path: str, texts: list[str]) -> list[np.ndarray]:
    """Ids of whole texts: their distinct stretches are looked up once."""
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
    words = lists.flatten().dictionary_encode()
    names = words.dictionary.to_numpy(zero_copy_only=False).tolist()
    memo = learned(path, names)
    found = list(map(memo.__getitem__, names))
    parts = list(map(found.__getitem__, words.indices.to_numpy().tolist()))
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return [np.frombuffer(b"".join(parts[a:b]), np.uint32) for a, b in zip(ends[:-1], ends[1:])]
