"""Best-fit packing of tokenized documents by a grouping genetic algorithm.

Documents longer than a sequence are cut. The pieces are dealt by hash into cells of a
bounded number; each cell is packed by several islands, each a task with a small
population of packings. A crossover puts whole well-filled sequences of one packing into
another, removes the sequences that hold the same pieces twice, and puts the pieces that
lose their place where they fit best. Between epochs every island gets the best packings
of the others of its cell. What fills its sequence worst after that is packed once more,
together with that of other cells.

Only lengths travel through the packing; ids join the result by document and piece.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm.tables import documents, stored
from lendmill.llm.tokens import encoder, with_end

LENGTH = 2048
#: Pieces of a cell, on average.
CELL_PIECES = 4096
#: Cells whose worst-filled sequences are packed together in the end.
CELLS_TOGETHER = 64
#: A sequence is well filled from this part on.
WELL_FILLED = 0.99
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
#: Children without a better packing, one after the other, that end an epoch.
PATIENCE = 12
#: Part of the well-filled sequences that a child takes over at most, and of its other
#: parent's sequences that are taken apart.
TAKEN = 0.1
MUTATED = 0.03
#: Pieces of a sequence that are tried for exchange, alone and in pairs.
EXCHANGED = 4


def _cut(tokenizer: str, end: int, length: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, counts, ids in encoder(tokenizer).encode(batch.column("text")):
                counts, ids = with_end(counts, ids, end)
                pieces = -(-counts // length)
                doc = np.repeat(np.arange(len(counts)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * length
                size = np.minimum(length, counts[doc] - start)
                at = (np.cumsum(counts) - counts)[doc] + start
                raw = np.ascontiguousarray(ids, "<u4").tobytes()
                parts = [raw[4 * a : 4 * (a + n)] for a, n in zip(at, size)]
                columns = {
                    "doc_id": batch.column("doc_id").slice(first, len(counts)).take(pa.array(doc)),
                    "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start.astype(np.int64)),
                    "length": pa.array(size.astype(np.int64)),
                    "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(parts, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def token_pieces(docs: DataFrame, tokenizer: str, end: int = 0, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and ``ids`` (little-endian
    unsigned 32-bit) of each piece. A null text is empty: its only id is ``end``."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return documents(docs, "doc_id", "text").mapInArrow(
        _cut(tokenizer, end, length, with_ids), schema + (", ids binary" if with_ids else "")
    )


class Packing:
    """Sequences as lists of places in ``sizes``, with the room left in each."""

    def __init__(self, sizes: list[int], length: int) -> None:
        self.sizes, self.length = sizes, length
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self._by_room: list[list[int]] = [[] for _ in range(length + 1)]
        self._rooms = 0  # a bit for each room that some sequence has

    def add(self, items: list[int]) -> None:
        """A sequence of its own."""
        self._note(len(self.bins), self.length - sum(self.sizes[i] for i in items))
        self.bins.append(items)

    def _note(self, b: int, room: int) -> None:
        if b < len(self.room):
            self.room[b] = room
        else:
            self.room.append(room)
        self._by_room[room].append(b)
        self._rooms |= 1 << room

    def place(self, items: list[int]) -> None:
        """Each item, in order, where it leaves the least room."""
        for i in items:
            size = self.sizes[i]
            fits = self._rooms >> size
            if not fits:
                self.add([i])
                continue
            room = size + (fits & -fits).bit_length() - 1
            same = self._by_room[room]
            b = same.pop()
            if not same:
                self._rooms &= ~(1 << room)
            self.bins[b].append(i)
            self._note(b, room - size)

    def filled(self) -> float:
        """Mean square of the filled parts: few full sequences beat many half full ones."""
        return sum(((self.length - r) / self.length) ** 2 for r in self.room) / max(1, len(self.bins))


def least_sequences(sizes: list[int], length: int) -> int:
    """A number of sequences that no packing can go below.

    Pieces of more than half a sequence never share one, and pieces of at least ``k`` find
    no room beside those of more than ``length - k``; the best ``k`` counts.
    """
    count = np.bincount(np.array(sizes, np.int64), minlength=length + 1)
    above = np.append(np.cumsum(count[::-1])[::-1], 0)  # pieces of at least a size
    total = np.append(np.cumsum((count * np.arange(length + 1))[::-1])[::-1], 0)
    k = np.arange(length // 2 + 1)
    half = length // 2 + 1
    alone, large = above[length - k + 1], above[half] - above[length - k + 1]
    room = large * length - (total[half] - total[length - k + 1])
    small = total[k] - total[half]
    return int((alone + large + np.maximum(0, -(-(small - room) // length))).max())


def _exchanges(b: int, items: list[int], room: int, sizes: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Sequence, length that goes out, length that may come in, and the one or two pieces."""
    few = items[:EXCHANGED]
    found = [(b, sizes[i], sizes[i] + room, i, -1) for i in few]
    return found + [
        (b, sizes[i] + sizes[j], sizes[i] + sizes[j] + room, i, j) for x, i in enumerate(few) for j in few[:x]
    ]


def replaced(bins: list[list[int]], rooms: list[int], free: list[int], sizes: list[int], length: int) -> list[int]:
    """Fill ``bins`` by exchange: one or two pieces go out for one or two of the ``free``
    that are longer together and still fit, the largest gains first, until none is left.
    Returns the pieces that are free then; they are shorter and find room more easily."""
    changed = {b for b, room in enumerate(rooms) if room}
    tried = np.empty((0, 5), np.int64)
    while free and changed:
        tried = tried[~np.isin(tried[:, 0], list(changed))]
        new = [e for b in changed if rooms[b] for e in _exchanges(b, bins[b], rooms[b], sizes)]
        tried = np.concatenate([tried, np.array(new, np.int64).reshape(-1, 5)])
        by: dict[int, list[int]] = {}
        for i in free:
            by.setdefault(sizes[i], []).append(i)
        have = np.array(sorted(by), np.int64)
        sums = have[:, None] + have[None, :]
        lone = [k for k, size in enumerate(have.tolist()) if len(by[size]) < 2]
        sums[lone, lone] = length + 1
        sums = np.concatenate([have, sums.ravel()])
        fits = np.flatnonzero(sums <= length)[::-1]
        first = np.full(length + 1, -1, np.int64)  # of each sum one of the pair, 0 for a single piece
        first[sums[fits]] = np.concatenate([np.zeros(len(have), np.int64), np.repeat(have, len(have))])[fits]
        best = np.maximum.accumulate(np.where(first >= 0, np.arange(length + 1), 0))
        put = best[tried[:, 2]]
        gain = put - tried[:, 1]
        better = np.flatnonzero(gain > 0)
        better = better[np.argsort(-gain[better], kind="stable")]
        changed, freed = set(), []
        for (b, out, _, one, two), total in zip(tried[better].tolist(), put[better].tolist()):
            if b in changed:
                continue
            half = int(first[total])
            wanted = (half, total - half) if half else (total,)
            if any(len(by[size]) < wanted.count(size) for size in wanted):
                continue
            goes = [one, two] if two >= 0 else [one]
            bins[b] = [by[size].pop() for size in wanted] + [i for i in bins[b] if i not in goes]
            rooms[b] -= total - out
            freed += goes
            changed.add(b)
        free = [i for items in by.values() for i in items] + freed
    return free


def crossed(one: Packing, other: Packing, rng: random.Random) -> Packing:
    """``one`` with some well-filled sequences of ``other`` in it, its worst-filled ones and
    some others taken apart, and what lost its place exchanged and placed again."""
    sizes, length = one.sizes, one.length
    most = length - int(WELL_FILLED * length)
    whole = [b for b, room in enumerate(other.room) if room <= most]
    chosen = rng.sample(whole, rng.randint(1, max(1, int(len(whole) * TAKEN)))) if whole else []
    kept, rooms = [list(other.bins[b]) for b in chosen], [other.room[b] for b in chosen]
    taken = {i for items in kept for i in items}
    apart = set(rng.sample(range(len(one.bins)), max(1, int(len(one.bins) * MUTATED)))) if one.bins else set()
    poor = sorted((b for b, room in enumerate(one.room) if room > most), key=lambda b: -one.room[b])
    apart.update(poor[: max(1, int(len(poor) * MUTATED))])
    displaced = []
    for b, items in enumerate(one.bins):
        if b not in apart and taken.isdisjoint(items):
            kept.append(list(items))
            rooms.append(one.room[b])
        else:
            displaced += [i for i in items if i not in taken]
    displaced = replaced(kept, rooms, displaced, sizes, length)
    child = Packing(sizes, length)
    for items in kept:
        child.add(items)
    displaced.sort(key=lambda i: -sizes[i])
    child.place(displaced)
    return child


def evolved(sizes: list[int], given: list[list[list[int]]], seed: int, length: int) -> Packing:
    """The best packing that evolves from the given ones and from best-fit ones.

    It ends when no packing can have fewer sequences, or when ``PATIENCE`` children one
    after the other have not made the best one better.
    """
    rng = random.Random(seed)
    full = [i for i, size in enumerate(sizes) if size == length]
    rest = sorted((i for i, size in enumerate(sizes) if size < length), key=lambda i: -sizes[i])
    least = least_sequences(sizes, length)
    people: list[tuple[int, float, int, Packing]] = []  # the best first

    def join(packing: Packing) -> None:
        people.append((len(packing.bins), -packing.filled(), born, packing))
        people.sort()

    born = 0
    for bins in given:
        packing = Packing(sizes, length)
        for items in bins:
            packing.add(list(items))
        join(packing)
        born += 1
    while len(people) < POPULATION and not (people and people[0][0] == least):
        packing = Packing(sizes, length)
        for i in full:
            packing.add([i])
        # the first in falling order of length, the others with the order disturbed
        shake = 0.0 if not people else 0.1
        packing.place(sorted(rest, key=lambda i: -sizes[i] * (1 + shake * rng.random())) if shake else rest)
        join(packing)
        born += 1
    idle = 0
    while people[0][0] > least and idle < PATIENCE:
        one, other = sorted(rng.sample(people, 2))
        before = people[0][0]
        join(crossed(one[3], other[3], rng))
        born += 1
        del people[POPULATION:]
        idle = 0 if people[0][0] < before else idle + 1
    return people[0][3]


def _packed_bins(bins: list[list[int]]) -> bytes:
    """The sequence of each place, in order of places."""
    out = np.empty(sum(map(len, bins)), np.int32)
    for b, items in enumerate(bins):
        out[items] = b
    return out.tobytes()


def _unpacked_bins(raw: bytes) -> list[list[int]]:
    of = np.frombuffer(raw, np.int32)
    order = np.argsort(of, kind="stable")
    return [part.tolist() for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1)] if len(of) else []


def _islands(length: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = [p["length"] for p in row["pieces"]]
                given = [_unpacked_bins(e) for e in row["elites"] or []]
                found = evolved(sizes, given, row["cell"] * 1009 + row["island"] * 31 + epoch, length)
                yield pa.RecordBatch.from_pydict(
                    {
                        "cell": pa.array([row["cell"]], pa.int64()),
                        "island": pa.array([row["island"]], pa.int32()),
                        "sequences": pa.array([len(found.bins)], pa.int32()),
                        "filled": pa.array([found.filled()]),
                        "bins": pa.array([_packed_bins(found.bins)], pa.binary()),
                    }
                )

    return run


def _placed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array([p["length"] for p in row["pieces"]], np.int64)
                of = np.frombuffer(row["bins"], np.int32)
                order = np.argsort(of, kind="stable")
                ends = np.cumsum(sizes[order])
                total = np.bincount(of, sizes).astype(np.int64)
                offset = np.empty(len(of), np.int64)
                offset[order] = ends - sizes[order] - (np.cumsum(total) - total)[of[order]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array([p["row"] for p in row["pieces"]], pa.int64()),
                        "cell": pa.array(np.full(len(of), row["cell"])),
                        "sequence": pa.array(of),
                        "offset": pa.array(offset),
                        "used": pa.array(total[of]),
                    }
                )

    return run


def _pack_cells(pieces: DataFrame, length: int) -> DataFrame:
    """``row``, ``cell``, ``sequence``, ``offset``, ``used`` for rows of ``row``, ``cell``, ``length``."""
    cells = stored(
        pieces.groupBy("cell").agg(
            F.sort_array(F.collect_list(F.struct("row", F.col("length").cast("int").alias("length")))).alias("pieces")
        ),
        "cells",
    )
    elites = None
    for epoch in range(EPOCHS):
        islands = cells.withColumn("island", F.explode(F.array(*(F.lit(i) for i in range(ISLANDS)))))
        if elites is None:
            islands = islands.withColumn("elites", F.lit(None).cast("array<binary>"))
        else:
            every = elites.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("island", "bins")))["bins"].alias("elites"))
            islands = islands.join(every, "cell")
        elites = stored(
            islands.repartition("cell", "island").mapInArrow(
                _islands(length, epoch), "cell long, island int, sequences int, filled double, bins binary"
            ),
            "elites",
        )
    best = elites.groupBy("cell").agg(
        F.min(F.struct("sequences", -F.col("filled"), "island", "bins"))["bins"].alias("bins")
    )
    return stored(
        cells.join(best, "cell").mapInArrow(
            _placed(length), "row long, cell long, sequence int, offset long, used long"
        ),
        "placed",
    )


def pack(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` (1 to ``length``) is its
    only column that is used. Repeated rows are packed each."""
    names = pieces.columns
    numbered = stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = F.col("length") == length
    rest = numbered.where(~whole).select("row", "length")
    cells = max(1, -(-rest.count() // CELL_PIECES))
    first = _pack_cells(
        rest.withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(cells))), length
    )
    poor = F.col("used") < int(WELL_FILLED * length)
    lengths = rest.select("row", "length")
    second = _pack_cells(
        first.where(poor)
        .select("row", F.floor(F.col("cell") / CELLS_TOGETHER).alias("cell"))
        .join(lengths, "row"),
        length,
    )
    # first-level sequences get even, second-level ones odd negative numbers
    number = lambda odd: -(2 * (F.shiftleft("cell", 20) + F.col("sequence")) + 1 + odd)
    placed = first.where(~poor).select("row", number(0).alias("sequence_id"), "offset").unionByName(
        second.select("row", number(1).alias("sequence_id"), "offset")
    )
    return (
        numbered.where(whole)
        .select(*names, F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
        .unionByName(numbered.where(~whole).join(placed, "row").select(*names, "sequence_id", "offset"))
    )


def packed_documents(docs: DataFrame, tokenizer: str, end: int = 0, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """:func:`token_pieces` of ``docs`` with their places. ``sequence_id`` is any number,
    one for each sequence; the pieces of a sequence lie one after the other from 0."""
    return pack(token_pieces(docs, tokenizer, end, length, with_ids), length)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``length``, ``ids`` and ``doc_ids`` of each sequence, from pieces with ids."""
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"),
    ).select(
        "sequence_id",
        "length",
        F.aggregate("parts", F.lit(b""), lambda all_ids, p: F.concat(all_ids, p["ids"])).alias("ids"),
        F.col("parts")["doc_id"].alias("doc_ids"),
    )
