"""Token ids of many texts with a public tokenizer, each distinct word encoded once.

For tokenizers that lower-case, drop white space and never join letters with anything
else, a text's ids are those of its words, one after the other. Texts are lower-cased,
unless they may hold a special token, and cut at blanks, line feeds and before a mark
that ends a word. The distinct pieces of a batch that are not known yet go to the
tokenizer, and numpy puts the ids of every text together. Each worker keeps a bounded
number of pieces: those of the last and the current generation.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST_KNOWN = 500_000
#: A longer piece is encoded, but not kept.
LONGEST_KNOWN = 64
BATCH_BYTES = 2 << 20

_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """First row, number of ids of each text, and all ids (uint32) for runs of rows;
        a null text has none."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        low = 0
        while low < len(texts):
            done = sizes[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(sizes, done + BATCH_BYTES, side="right")))
            yield low, *self._run(texts.slice(low, high - low))
            low = high

    def _run(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.replace_substring(texts, "\n", " ")
        lower = pc.replace_substring_regex(pc.ascii_lower(plain), r"([a-z])([.,]) ", r"\1 \2 ")
        lists = pc.split_pattern(pc.if_else(pc.match_substring(plain, "<|"), plain, lower), " ")
        pieces = lists.flatten().dictionary_encode()
        ids = self._ids(pieces.dictionary.to_pylist())
        lengths = np.array([len(i) // 4 for i in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), np.uint32)
        used = pieces.indices.to_numpy(zero_copy_only=False)
        each = lengths[used]
        starts = (np.cumsum(lengths) - lengths)[used]
        before = np.cumsum(each) - each
        at = np.repeat(starts - before, each) + np.arange(each.sum())
        words = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(words)])]
        return np.diff(ends), flat[at] if len(at) else np.empty(0, np.uint32)

    def _ids(self, pieces: list[str]) -> list[bytes]:
        ids = [self.known.get(p) for p in pieces]
        unseen = [i for i, found in enumerate(ids) if found is None]
        missing = []
        for i in unseen:
            ids[i] = self.older.get(pieces[i])
            if ids[i] is None:
                missing.append(i)
        encoded = self.tokenizer.encode_batch_fast([pieces[i] for i in missing], add_special_tokens=False)
        for i, e in zip(missing, encoded):
            ids[i] = np.array(e.ids, np.uint32).tobytes()
        self.known.update((pieces[i], ids[i]) for i in unseen if len(pieces[i]) <= LONGEST_KNOWN)
        if len(self.known) > MOST_KNOWN:
            self.older, self.known = self.known, {}
        return ids


def with_end(counts: np.ndarray, ids: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the id ``end`` after each text."""
    return counts + 1, np.insert(ids, np.cumsum(counts), np.uint32(end))
