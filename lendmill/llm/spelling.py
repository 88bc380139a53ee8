"""Spelling variants: words of a corpus that are one edit apart, found by Gram matrices.

Words lie in blocks of equal letter counts over a few groups of letters, so the words of a
block are equally long. One inserted, deleted or replaced letter leads to the same block or
to one of a few adjacent ones, of the same or of the next length. For each block NumPy
multiplies the letter counts of its words with those of the words of its adjacent blocks;
the products give all squared distances of letter counts at once. An edit changes that
distance by at most two; the pairs that keep to it are verified letter by letter.

Columns: ``doc_id`` (any type that casts to text) and ``text``; others are not looked at.
A null or empty text has no words, an empty table gives no rows, repeated rows count as
often as they occur. Words of a row without ``doc_id`` are taken as they are written.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.tables import documents, stored

LEAST_LENGTH = 7
LEAST_ROWS = 2
#: One run in so many loses a letter.
SLIPS = 31
#: A form is at least so many times as frequent as the words that lead to it.
TIMES = 10

# The letters of a word. Only A to Z have a lower case here.
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALL = CAPITALS.lower()
ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
LETTERS = SMALL + ACCENTED

GROUPS = 8
#: Counts are the digits of a block's number in this base. A count beyond it carries over:
#: then blocks share a number, which costs comparisons but loses none.
BASE = 64
NUMBERS = BASE**GROUPS
#: The words of a block are cut into chunks of about so many letters.
CHUNK_LETTERS = 32_768
#: So many words are turned into letter counts at once.
PIECE_WORDS = 16_384
#: float32 sums are exact as long as no word is longer.
LONGEST_FLOAT32 = 2_000

NEAR = "word string, other string, other_n long"


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``, its number of occurrences, for all words that are long and
    frequent enough, after the slips."""
    rows = documents(docs, "doc_id", "text")
    # Shorter runs cannot give a word; the pattern has to see none of them.
    pattern = f"[{SMALL}{ACCENTED[0]}-{ACCENTED[-1]}]{{{LEAST_LENGTH},}}"
    runs = rows.select(
        "doc_id",
        F.explode(
            F.regexp_extract_all(F.translate("text", CAPITALS, SMALL), F.lit(pattern), F.lit(0))
        ).alias("run"),
    )
    number = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")))
    place = (F.col("number") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), place), F.substr("run", place + 2))
    words = runs.withColumn("number", number).select(
        F.when(F.col("number") % SLIPS == 0, slipped).otherwise(F.col("run")).alias("word")
    )
    counts = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= LEAST_ROWS)


def block_number(word: Column) -> Column:
    """The counts of the groups of letters as one number; a letter more or less in a group
    adds or takes that group's power, modulo ``NUMBERS``."""
    number = F.lit(0).cast("long")
    for group in range(GROUPS):
        without = F.translate(word, LETTERS[group::GROUPS], "")
        count = (F.length(word) - F.length(without)).cast("long")
        number += count % (NUMBERS // BASE**group) * BASE**group
    return number % NUMBERS


def steps() -> list[int]:
    """From a block to itself, to those one letter longer, and to half of the others of its
    length, so that each two adjacent blocks meet once."""
    powers = [BASE**g for g in range(GROUPS)]
    replaced = [a - b for i, b in enumerate(powers) for a in powers[i + 1 :]]
    return [0, *powers, *replaced]


def near_words(words: DataFrame) -> DataFrame:
    """For each two words exactly one edit apart a row from each side: ``word``, ``other``
    and ``other_n``. ``words`` has distinct words and is read more than once.

    A block is cut into chunks of bounded size. The chunk that receives comes first in its
    group of rows and is held; the chunks sent to it stream past, whatever their number.
    """
    words = words.withColumn("block", block_number(F.col("word")))
    sizes = words.groupBy("block").agg(
        F.ceil(F.sum(F.length("word")) / CHUNK_LETTERS).cast("int").alias("chunks")
    )
    chunk = F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
    packed = (
        words.join(sizes, "block")
        .withColumn("chunk", chunk)
        .groupBy("block", "chunk")
        .agg(F.collect_list(F.struct("word", "n")).alias("members"))
    )
    packed = stored(packed, "spelling-blocks")
    step = F.explode(F.array(*[F.lit(s).cast("long") for s in steps()])).alias("step")
    sent = packed.select(
        F.col("block").alias("origin"), F.col("chunk").alias("part"), "members", step
    ).withColumn("block", F.pmod(F.col("origin") + F.col("step"), F.lit(NUMBERS).cast("long")))
    sent = sent.join(sizes, "block").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    )
    sent = sent.where((F.col("step") != 0) | (F.col("chunk") > F.col("part")))
    columns = ["block", "chunk", "sent", "members"]
    groups = packed.withColumn("sent", F.lit(False)).select(columns)
    groups = groups.unionByName(sent.withColumn("sent", F.lit(True)).select(columns))
    groups = groups.repartition("block", "chunk").sortWithinPartitions("block", "chunk", "sent")
    return groups.mapInArrow(_compare, NEAR)


def spelling_variants(docs: DataFrame) -> DataFrame:
    """One row for each word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    words = stored(word_counts(docs), "spelling-words")
    return grouped(words, near_words(words))


def grouped(words: DataFrame, near: DataFrame) -> DataFrame:
    """The near words of each word counted, and the words followed to their roots.

    A form is ten times as frequent as its word, so a chain has no circle and at most 19
    words. Each round doubles the way, until none is left to go.
    """
    # The smallest struct is the most frequent word, the first in code-point order of several.
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    summed = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    rows = words.join(summed, "word", "left")
    frequent = -F.col("best.less") >= TIMES * F.col("n")
    rows = rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("best.other")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n"),
    )
    rows = stored(rows, "spelling-forms")
    ways = rows.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    left = True
    while left:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = stored(ways.join(further, "root", "left"), "spelling-ways")
        left = not ways.where(F.col("next").isNotNull()).isEmpty()
        ways = ways.select("word", F.coalesce("next", "root").alias("root"))
    rows = rows.join(ways, "word", "left")
    return rows.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


class _Words:
    """The words of consecutive rows: letters as Latin-1 bytes and where each word lies."""

    def __init__(self, members: pa.Array) -> None:
        flat = members.flatten()
        self.text, self.n = flat.field("word"), flat.field("n")
        self.ends = np.cumsum(pc.list_value_length(members).to_numpy(zero_copy_only=False))
        self.letters = np.frombuffer("".join(self.text.to_pylist()).encode("latin-1"), np.uint8)
        self.lengths = pc.utf8_length(self.text).to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def factors(self) -> tuple[np.ndarray, np.ndarray]:
        """Two matrices whose product holds the squared distances of all letter counts."""
        code = np.full(256, -1)
        code[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
        rows = len(self.lengths)
        at = np.repeat(np.arange(rows) * len(LETTERS), self.lengths) + code[self.letters]
        counts = np.bincount(at, minlength=rows * len(LETTERS)).reshape(rows, -1)
        exact = self.lengths.max(initial=0) <= LONGEST_FLOAT32
        counts = counts.astype(np.float32 if exact else np.float64)
        squares = (counts * counts).sum(axis=1, keepdims=True)
        ones = np.ones_like(squares)
        return np.hstack([counts, squares, ones]), np.hstack([-2 * counts, ones, squares])


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, chunk and side -> the near words of each chunk that receives."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        words = np.cumsum(pc.list_value_length(batch["members"]).to_numpy(zero_copy_only=False))
        low = 0
        while low < batch.num_rows:
            done = words[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(words, done + PIECE_WORDS, side="right")))
            piece = batch.slice(low, high - low)
            if held is not None and piece["sent"][0].as_py():
                piece = pa.concat_batches([held, piece])
            yield _near(piece, again=held is not None and piece.num_rows > high - low)
            last = np.flatnonzero(~piece["sent"].to_numpy(zero_copy_only=False))[-1]
            held = piece.slice(last, 1)
            low = high


def _near(piece: pa.RecordBatch, again: bool) -> pa.RecordBatch:
    """The near words of some rows that start with a receiving one; ``again`` if that one was
    compared with itself before."""
    words = _Words(piece["members"])
    left, right = words.factors()
    heads = np.flatnonzero(~piece["sent"].to_numpy(zero_copy_only=False))
    ends = words.ends[np.append(heads[1:] - 1, len(words.ends) - 1)]
    ones, others = [], []
    for head, end in zip(heads, ends):
        first = words.ends[head - 1] if head else 0
        middle = words.ends[head]
        low = middle if again and head == 0 else first
        distances = left[low:end] @ right[first:middle].T
        other, one = np.divmod(np.flatnonzero(distances.ravel() <= 2), middle - first)
        other, one = other + low, one + first
        later = other > one
        ones.append(one[later])
        others.append(other[later])
    one, other = np.concatenate(ones), np.concatenate(others)
    apart = _one_edit(words, one, other)
    one, other = one[apart], other[apart]
    both = pa.array(np.concatenate([one, other])), pa.array(np.concatenate([other, one]))
    found = [words.text.take(both[0]), words.text.take(both[1]), words.n.take(both[1])]
    return pa.RecordBatch.from_arrays(found, names=["word", "other", "other_n"])


def _one_edit(words: _Words, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which pairs are one replaced, inserted or deleted letter apart."""
    swapped = words.lengths[one] > words.lengths[other]
    short, long = np.where(swapped, other, one), np.where(swapped, one, other)
    length, more = words.lengths[short], words.lengths[long] - words.lengths[short]
    found = np.zeros(len(one), bool)
    for size in np.unique(length):
        step = max(1, (1 << 22) // int(size))
        places = np.arange(size)
        for kind in (0, 1):
            pairs = np.flatnonzero((length == size) & (more == kind))
            for some in np.split(pairs, range(step, len(pairs), step)):
                a = words.letters[words.starts[short[some], None] + places]
                starts = words.starts[long[some], None]
                same = a == words.letters[starts + places]
                if kind:
                    # Equal up to the first difference, and from there on to the next letter.
                    before = np.logical_and.accumulate(same, axis=1)
                    found[some] = (before | (a == words.letters[starts + places + 1])).all(axis=1)
                else:
                    found[some] = same.sum(axis=1) == size - 1
    return found
