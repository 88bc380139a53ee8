"""Byte-level BPE in both directions, from a public tokenizer's vocabulary and merges.

A text is cut at special tokens and into pieces by the tokenizer's pattern. The symbols of
a piece form a doubly linked list; a priority queue holds the ranks of their neighbours'
merges. The best one is taken, its two symbols become one, and its new neighbours enter the
queue; entries whose symbols have changed since are skipped. Decoding puts the strings of
the vocabulary one after the other.

Every text is encoded whole. Each worker keeps the ids of a bounded number of pieces.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from lendmill.llm.tables import documents

# The pattern that the byte-level form cuts texts by, for the classes of
# letters, numbers and white space, and the characters of the last.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# The letters and numbers of Unicode 16 that Unicode 15 lacks. The tokenizers
# library goes by version 16, Python's own tables here by 15, the regex library by a later one.
LATER_LETTERS = (
    "\u1c89\u1c8a\ua7cb-\ua7cd\ua7da-\ua7dc\U000105c0-\U000105f3\U00010d4a-\U00010d65"
    "\U00010d6f-\U00010d85\U00010ec2-\U00010ec4\U00011380-\U00011389\U0001138b\U0001138e"
    "\U00011390-\U000113b5\U000113b7\U000113d1\U000113d3\U00011bc0-\U00011be0"
    "\U00013460-\U000143fa\U00016100-\U0001611d\U00016d40-\U00016d6c\U00018cff"
    "\U0001e5d0-\U0001e5ed\U0001e5f0"
)
LATER_NUMBERS = (
    "\U00010d40-\U00010d49\U000116d0-\U000116e3\U00011bf0-\U00011bf9\U00016130-\U00016139"
    "\U00016d70-\U00016d79\U0001ccf0-\U0001ccf9\U0001e5f1-\U0001e5fa"
)
MOST_KNOWN = 400_000
#: A longer piece is encoded, but not kept.
LONGEST_KNOWN = 64
#: Stands in the list for a symbol that became part of the one before it; no pair has it.
GONE = -1
PLACE_BITS = 32
LAST_PLACE = (1 << PLACE_BITS) - 1
BATCH_BYTES = 2 << 20
BATCH_IDS = 1 << 20

_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """One per worker process and tokenizer file."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def cutter() -> Callable[[str], list[str]]:
    """Cuts a text into pieces. The classes of the regex library are the faster ones; texts
    with a character that it knows from a later Unicode go by the exact ranges."""
    import regex

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    kinds = list(map(unicodedata.category, every))
    named, exact = {"L": r"\p{L}", "N": r"\p{N}", "S": r"\s"}, {"S": WHITE}
    unlike = {*regex.findall(r"\s", every)} ^ {*re.findall(f"[{WHITE}]", every)}
    for kind, later in (("L", LATER_LETTERS), ("N", LATER_NUMBERS)):
        held = {c for c, k in zip(every, kinds) if k[0] == kind} | {*re.findall(f"[{later}]", every)}
        exact[kind] = _ranges(sorted(held))
        unlike |= held ^ {*regex.findall(named[kind], every)}
    fast = regex.compile(PATTERN.format(**named)).findall
    slow = re.compile(PATTERN.format(**exact)).findall
    odd = re.compile(f"[{_ranges(sorted(unlike))}]").search if unlike else lambda text: None
    return lambda text: fast(text) if text.isascii() or not odd(text) else slow(text)


def _ranges(characters: list[str]) -> str:
    """Ascending characters as the inside of a character class."""
    codes = np.array([ord(c) for c in characters])
    breaks = np.flatnonzero(np.diff(codes) != 1)
    firsts, lasts = codes[np.append(0, breaks + 1)], codes[np.append(breaks, len(codes) - 1)]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(firsts.tolist(), lasts.tolist()))


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it can be printed, for the others
    those from U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (chr(0x100 + i) for i in range(256))
    return [chr(b) if b in shown else next(hidden) for b in range(256)]


class Coder:
    """A tokenizer file of the byte-level BPE kind, without what it does to length."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        model, form, added = layout["model"], layout["pre_tokenizer"], layout["added_tokens"]
        plain = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if (
            (model["type"], form["type"]) != ("BPE", "ByteLevel")
            or layout["normalizer"]
            or form["add_prefix_space"]
            or any(model.get(option) for option in plain)
            or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        ):
            raise ValueError(f"not a plain byte-level BPE: {path}")
        letters = byte_letters()
        byte_of = {letter: bytes([b]) for b, letter in enumerate(letters)}
        vocabulary: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in added}
        #: The bytes of each id, and none at the end. A letter that stands for no byte is
        #: written as it is.
        self.strings = [b""] * (2 + max([*vocabulary.values(), *self.special.values()]))
        for token, number in [*vocabulary.items(), *self.special.items()]:
            self.strings[number] = b"".join(byte_of.get(c, c.encode()) for c in token)
        self.first = [vocabulary.get(letter) for letter in letters]
        #: Rank by left * size + right, and what each rank's merge gives.
        self.size = len(self.strings)
        self.ranks: dict[int, int] = {}
        self.wholes: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            one, other = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[vocabulary[one] * self.size + vocabulary[other]] = rank
            self.wholes.append(vocabulary[one + other])
        self.pieces = cutter()
        # Of special tokens that start at one place the longest counts.
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, names))})").split if names else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, as int32."""
        parts = self.cut(text) if self.cut else [text]
        found: list[bytes] = []
        for i, part in enumerate(parts):
            if i % 2:
                found.append(np.int32(self.special[part]).tobytes())
            elif part:
                known = self.known.get
                found.extend([known(p) or self._ids(p) for p in self.pieces(part)])
        return np.frombuffer(b"".join(found), np.int32)

    def _ids(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", self.merge(piece.encode())).tobytes()
        if len(piece) <= LONGEST_KNOWN:
            self.known[piece] = ids
            if len(self.known) > MOST_KNOWN:
                self.older, self.known = self.known, {}
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """The symbols of one piece after all merges. Bytes without a symbol are left out."""
        symbols = [s for b in piece if (s := self.first[b]) is not None]
        end, size, rank_of, wholes = len(symbols), self.size, self.ranks.get, self.wholes
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        # An entry is rank and left symbol in one number, so equal ranks go from left to right.
        queue = [
            (rank << PLACE_BITS) + i
            for i, (one, other) in enumerate(zip(symbols, symbols[1:]))
            if (rank := rank_of(one * size + other)) is not None
        ]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            rank, left = entry >> PLACE_BITS, entry & LAST_PLACE
            right = after[left]
            # Stale: the symbol is the last now, is gone, or its pair has another merge.
            if right == end or rank_of(symbols[left] * size + symbols[right]) != rank:
                continue
            whole = wholes[rank]
            symbols[left], symbols[right] = whole, GONE
            following = after[left] = after[right]
            if following < end:
                before[following] = left
                if (rank := rank_of(whole * size + symbols[following])) is not None:
                    heappush(queue, (rank << PLACE_BITS) + left)
            if (leading := before[left]) >= 0:
                if (rank := rank_of(symbols[leading] * size + whole)) is not None:
                    heappush(queue, (rank << PLACE_BITS) + leading)
        return [s for s in symbols if s != GONE]

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids, special tokens included; an id beyond the vocabulary has no
        string, and bytes that are no UTF-8 become U+FFFD."""
        last = len(self.strings) - 1
        inside = np.where((ids >= 0) & (ids < last), ids, last)
        return b"".join(map(self.strings.__getitem__, inside.tolist())).decode("utf-8", "replace")


def encoded(docs: DataFrame, path: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text as ``array<int>``; a null text has an empty array.

    A column named ``ids`` is replaced, all others are kept. An empty table stays empty.
    """
    schema = _with(docs.schema, ids, ArrayType(IntegerType(), False))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for part in _parts(batches, lambda b: pc.binary_length(b[text]), BATCH_BYTES):
            found = [code.encode(t or "") for t in part[text].to_pylist()]
            offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
            flat = np.concatenate([*found, np.empty(0, np.int32)])
            yield _replaced(part, schema, ids, pa.ListArray.from_arrays(offsets, flat))

    return docs.mapInArrow(work, schema)


def decoded(rows: DataFrame, path: str, *, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of each array of ids; a null array has an empty text, a null id
    none."""
    schema = _with(rows.schema, text, StringType())

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for part in _parts(batches, lambda b: pc.list_value_length(b[ids]), BATCH_IDS):
            lists = pc.list_value_length(part[ids]).fill_null(0).to_numpy(zero_copy_only=False)
            flat = part[ids].flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists).tolist()
            found = [code.decode(flat[a:b]) for a, b in zip([0, *ends], ends)]
            yield _replaced(part, schema, text, pa.array(found, pa.string()))

    return rows.mapInArrow(work, schema)


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """Each document encoded and decoded again: ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the
    decimal ids, joined by commas) and ``decoded_sha256`` (of the text in UTF-8).

    A null or empty text has no ids; its digests are those of an empty text. Rows without
    ``doc_id`` and repeated rows are kept as they are.
    """
    rows = decoded(encoded(documents(docs, "doc_id", "text"), path).select("doc_id", "ids"), path)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _with(schema: StructType, name: str, kind) -> StructType:
    kept = [f for f in schema if f.name.lower() != name.lower()]
    return StructType(kept).add(name, kind)


def _replaced(part: pa.RecordBatch, schema: StructType, name: str, column: pa.Array) -> pa.RecordBatch:
    arrays = [column if f.name == name else part[f.name] for f in schema]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def _parts(batches: Iterable[pa.RecordBatch], size, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows that are not larger than ``most`` together, or one row."""
    for batch in batches:
        sizes = np.cumsum(size(batch).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        low = 0
        while low < batch.num_rows:
            done = sizes[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(sizes, done + most, side="right")))
            yield batch.slice(low, high - low)
            low = high
