"""Token ids as raw binary shards with a minimal perfect hash index.

A dataset is a folder of

* ``ids-NNNNN.u16`` or ``.u32``: the ids of consecutive documents in ascending ``doc_id``
  order as little-endian unsigned integers of 16 or, for a vocabulary that needs them, 32
  bits, without any header;
* ``index-NNNNN.mph``: for the keys of one hash bucket a minimal perfect hash and, in its
  slots, a fingerprint of the key, the shard, the offset in ids and the number of ids.

A key is looked up with one bucket, a few bit tests and one slot, whatever the size of the
dataset; the fingerprint tells a key that is not there. The hash is built level by level:
keys that hash to a bit of their own at a level take the rank of that bit as their slot,
the others go to the next level.

Files are written under names of the attempt and renamed when complete, so a lost or
repeated task leaves no half shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendmill.llm.tables import documents, stored
from lendmill.llm.tokens import encoder, with_end
from lendmill.llm.words import mix
from lendmill.workspace import scratch_path

#: Text bytes of a shard and keys of an index file, on average.
SHARD_BYTES = 16 << 20
BUCKET_KEYS = 1 << 15

_MAGIC = b"MPH1"
_LEVELS = 48
_SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("start", "<u8"), ("length", "<u8")])


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _write(path: str, parts: Iterator[bytes]) -> None:
    files, target = _place(path)
    own = f"{target}.{TaskContext.get().taskAttemptId()}.tmp"
    with files.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    files.move(own, target)


class Index:
    """Slots of a set of 64-bit hashed keys."""

    def __init__(self, levels: list[np.ndarray], slots: np.ndarray, rest: np.ndarray) -> None:
        self.levels, self.slots, self.rest = levels, slots, rest
        counts = [np.bitwise_count(bits).astype(np.int64) for bits in levels]
        self.ranks = [np.cumsum(c) - c for c in counts]
        totals = np.array([int(c.sum()) for c in counts], np.int64)
        self.bases = np.cumsum(totals) - totals

    @staticmethod
    def _bit(keys: np.ndarray, level: int, words: int) -> np.ndarray:
        return mix(keys, level + 1) % np.uint64(64 * words)

    @classmethod
    def build(cls, keys: np.ndarray, shard: np.ndarray, start: np.ndarray, length: np.ndarray) -> Index:
        """For distinct ``keys``. What is left after the last level is kept as a sorted list."""
        levels, left = [], keys
        while len(left) and len(levels) < _LEVELS:
            words = max(1, -(-2 * len(left) // 64))
            bit = cls._bit(left, len(levels), words)
            times = np.bincount(bit.astype(np.int64), minlength=64 * words)
            single = times == 1
            levels.append(np.packbits(single, bitorder="little").view("<u8").copy())
            left = left[times[bit.astype(np.int64)] > 1]
        index = cls(levels, np.zeros(len(keys), _SLOT), np.sort(left))
        slot = index.slot(keys)
        index.slots["fingerprint"][slot] = mix(keys, 99) >> np.uint64(32)
        index.slots["shard"][slot] = shard
        index.slots["start"][slot] = start
        index.slots["length"][slot] = length
        return index

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot, or -1, for one that is not in the set."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            bit = self._bit(keys[open_], level, len(bits))
            word, within = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
            here = (bits[word] >> within) & np.uint64(1) == 1
            below = bits[word] & ((np.uint64(1) << within) - np.uint64(1))
            slot = self.bases[level] + self.ranks[level][word] + np.bitwise_count(below)
            found[open_[here]] = slot[here]
            open_ = open_[~here]
        if len(self.rest) and len(open_):
            at = np.searchsorted(self.rest, keys[open_]).clip(max=len(self.rest) - 1)
            there = self.rest[at] == keys[open_]
            found[open_[there]] = len(self.slots) - len(self.rest) + at[there]
        return found

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot entries of the keys; length 0 and shard 2^32 - 1 where there is none."""
        slot = self.slot(keys)
        entries = np.zeros(len(keys), _SLOT)
        entries["shard"] = 0xFFFFFFFF
        known = slot >= 0
        entries[known] = self.slots[slot[known]]
        foreign = known & (entries["fingerprint"] != mix(keys, 99) >> np.uint64(32))
        entries[foreign] = np.array((0, 0xFFFFFFFF, 0, 0), _SLOT)
        return entries

    def dump(self) -> bytes:
        sizes = [len(bits) for bits in self.levels]
        head = struct.pack("<4sIQQ", _MAGIC, len(sizes), len(self.slots), len(self.rest))
        return b"".join(
            [head, np.array(sizes, "<u8").tobytes(), *(b.tobytes() for b in self.levels),
             self.rest.astype("<u8").tobytes(), self.slots.tobytes()]
        )

    @classmethod
    def load(cls, raw: bytes) -> Index:
        magic, levels, slots, rest = struct.unpack_from("<4sIQQ", raw)
        if magic != _MAGIC:
            raise ValueError("not an index file")
        at = struct.calcsize("<4sIQQ")
        sizes = np.frombuffer(raw, "<u8", levels, at)
        at += 8 * levels
        bits = []
        for size in sizes.tolist():
            bits.append(np.frombuffer(raw, "<u8", size, at))
            at += 8 * size
        left = np.frombuffer(raw, "<u8", rest, at)
        return cls(bits, np.frombuffer(raw, _SLOT, slots, at + 8 * rest), left)


def id_type(tokenizer: str, end: int) -> str:
    """The numpy type of the ids in the files, by the size of the vocabulary."""
    return "<u2" if max(end, encoder(tokenizer).tokenizer.get_vocab_size() - 1) < 1 << 16 else "<u4"


def _shard_path(folder: str, shard: int, kind: str) -> str:
    return f"{folder}/ids-{shard:05d}.u{8 * np.dtype(kind).itemsize}"


def _encoding(folder: str, tokenizer: str, end: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        files, target = _place(_shard_path(folder, shard, kind))
        own = f"{target}.{TaskContext.get().taskAttemptId()}.tmp"
        at = 0
        with files.open_output_stream(own) as out:
            for batch in batches:
                for first, counts, ids in encoder(tokenizer).encode(batch.column("text")):
                    counts, ids = with_end(counts, ids, end)
                    out.write(np.ascontiguousarray(ids, kind).tobytes())
                    starts = at + np.cumsum(counts) - counts
                    at += int(counts.sum())
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": batch.column("doc_id").slice(first, len(counts)),
                            "shard": pa.array(np.full(len(counts), shard, np.int32)),
                            "start": pa.array(starts),
                            "length": pa.array(counts),
                        }
                    )
        files.move(own, target)

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end: int) -> DataFrame:
    """Write ``docs`` and return the keys: ``doc_id``, ``copy``, ``shard``.

    Rows without ``doc_id`` come first. ``copy`` numbers the rows of one ``doc_id`` from 0,
    in the order in which they were written; both together are the key of the index. A
    null text has the id ``end`` only. ``folder`` must be one that all executors share.
    """
    rows = documents(docs, "doc_id", "text")
    files, target = _place(folder)
    files.create_dir(target)
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    ordered = rows.repartitionByRange(int(shards), F.col("doc_id").asc_nulls_first())
    written = stored(
        ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first()).mapInArrow(
            _encoding(folder, tokenizer, end, id_type(tokenizer, end)), "doc_id long, shard int, start long, length long"
        ),
        "written",
    )
    copies = Window.partitionBy("doc_id").orderBy("shard", "start")
    keyed = written.withColumn("copy", F.row_number().over(copies) - 1)
    buckets = max(1, -(-written.count() // BUCKET_KEYS))
    stored(
        _bucketed(keyed, buckets)
        .groupBy("bucket")
        .applyInArrow(_indexing(folder), "bucket int, keys long"),
        "index",
    )
    return _bucketed(keyed, buckets).select("doc_id", "copy", "key", "bucket")


def _bucketed(keyed: DataFrame, buckets: int) -> DataFrame:
    """``key``: the hash of document and copy; ``bucket``: the index file it is in."""
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "copy")
    return keyed.withColumn("key", key).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))


def _indexing(folder: str):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        numbers = lambda name: table.column(name).to_numpy()
        keys = numbers("key").astype(np.int64).view(np.uint64)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two keys have one 64-bit hash")
        index = Index.build(keys, numbers("shard"), numbers("start"), numbers("length"))
        _write(f"{folder}/index-{bucket:05d}.mph", iter([index.dump()]))
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "keys": pa.array([len(keys)], pa.int64())})

    return run


def _read(path: str) -> bytes:
    files, target = _place(path)
    with files.open_input_file(target) as f:
        return f.read()


def _finding(folder: str):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        index = Index.load(_read(f"{folder}/index-{bucket:05d}.mph"))
        found = index.find(table.column("key").to_numpy().astype(np.int64).view(np.uint64))
        there = pa.array(found["shard"] != 0xFFFFFFFF)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "copy": table.column("copy"),
                "shard": pa.array(found["shard"].astype(np.int64)),
                "offset": pa.array(found["start"].astype(np.int64)),
                "n_tokens": pa.array(found["length"].astype(np.int64)),
            }
        ).filter(there)

    return run


def look_up(folder: str, keys: DataFrame) -> DataFrame:
    """``doc_id``, ``copy``, ``shard``, ``offset``, ``n_tokens`` of the ``keys`` that the index has."""
    return keys.select("doc_id", "copy", "key", "bucket").groupBy("bucket").applyInArrow(
        _finding(folder), "doc_id long, copy int, shard long, offset long, n_tokens long"
    )


def _reading(folder: str, kind: str):
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            parts = []
            rows = (batch.column(c).to_pylist() for c in ("shard", "offset", "n_tokens"))
            for shard, offset, n in zip(*rows):
                if shard != name:
                    if source:
                        source.close()
                    files, target = _place(_shard_path(folder, shard, kind))
                    name, source = shard, files.open_input_file(target)
                ids = np.frombuffer(source.read_at(width * n, width * offset), kind)
                parts.append(zlib.crc32(ids.astype("<u4").tobytes()))
            yield batch.append_column("ids_crc32", pa.array(parts, pa.int64()))
        if source:
            source.close()

    return run


def read_digests(folder: str, keys: DataFrame, kind: str) -> DataFrame:
    """``doc_id``, ``copy``, ``start`` (ids of all documents before), ``n_tokens``,
    ``ids_crc32`` (of the ids as 32-bit integers) of each key, read from the index and the
    shards, whose ids are of type ``kind``."""
    found = look_up(folder, keys)
    read = stored(
        found.repartition("shard").sortWithinPartitions("shard", "offset").mapInArrow(
            _reading(folder, kind), "doc_id long, copy int, shard long, offset long, n_tokens long, ids_crc32 long"
        ),
        "read",
    )
    before = (
        read.groupBy("shard")
        .agg(F.max(F.col("offset") + F.col("n_tokens")).alias("ids"))
        .withColumn("before", F.sum("ids").over(Window.orderBy("shard")) - F.col("ids"))
    )
    return read.join(before, "shard").select(
        "doc_id", "copy", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_digests(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Write ``docs`` to a folder below ``spark.checkpoint.dir`` and read all of it back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_digests(folder, write_token_files(docs, folder, tokenizer, end), id_type(tokenizer, end))
