"""Sharding by a hierarchical weighted hash tree.

A document descends from the root through region and rack to a shard. At each step every
child draws ``ln(u) / weight`` for the document, ``u`` being a hash of the document and
the child's name, and the largest draw wins. So a child gets documents in proportion to
its weight, and a change of weights below a node moves documents only where draws change:
a node that gets heavier takes from its siblings and nothing else moves.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.tables import documents, stored

#: Rows of a shard that are numbered together.
CHUNK_ROWS = 8192


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(shards: int, regions: int = 2, racks: int = 2) -> list[Shard]:
    """Shards 0 and up, dealt out to ``regions`` of ``racks`` each."""
    places = [(f"region{r}", f"rack{k}") for r in range(regions) for k in range(racks)]
    return [Shard(*places[s * len(places) // shards], s) for s in range(shards)]


def grown(tree: Sequence[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard, in a region of its own: only the root's draws change, so all that
    moves, moves into the new shard."""
    number = max((s.shard for s in tree), default=-1) + 1
    return [*tree, Shard(f"region of {number}", "rack0", number, weight)]


def _levels(tree: Sequence[Shard]) -> list[dict[str, dict[str, float]]]:
    """For each step: children of each node and their weights, all named by their paths."""
    steps: list[dict[str, dict[str, float]]] = [{}, {}, {}]
    for s in tree:
        path = ["", s.region, f"{s.region}/{s.rack}", f"{s.region}/{s.rack}/{s.shard}"]
        for step, parent, child in zip(steps, path, path[1:]):
            weights = step.setdefault(parent, {})
            weights[child] = weights.get(child, 0.0) + s.weight
    return steps


def place(key: Column, tree: Sequence[Shard]) -> Column:
    """The shard of ``key``; the same for equal keys, null among them."""
    if not tree or any(s.weight <= 0 for s in tree) or len({s.shard for s in tree}) < len(tree):
        raise ValueError("a tree needs shards of different numbers and positive weights")
    where = F.lit("")
    for step in _levels(tree):
        children = F.create_map(
            *(
                part
                for parent, weights in step.items()
                for part in (
                    F.lit(parent),
                    F.array(
                        *(
                            F.struct(F.lit(name).alias("name"), F.lit(weight).alias("weight"))
                            for name, weight in weights.items()
                        )
                    ),
                )
            )
        )
        draws = F.transform(
            children[where],
            lambda child: F.struct(
                (F.log(_uniform(F.xxhash64(key, child["name"]))) / child["weight"]).alias("draw"),
                child["name"].alias("name"),
            ),
        )
        where = F.array_max(draws)["name"]
    return F.substring_index(where, "/", -1).cast("int")


def _uniform(hashed: Column) -> Column:
    """Between 0 and 1, neither included."""
    return (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / float(1 << 53)


def sharded(docs: DataFrame, tree: Sequence[Shard]) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes and 1), ``text_crc32``, ``shard``, ``grown_shard``,
    ``slot`` for each row.

    A null text has size 1 and the checksum of an empty one. ``slot`` numbers the rows of
    a shard from 0 without gaps. No task holds a whole shard: chunks are numbered on their
    own and shifted by the rows of the chunks before. Rows of one ``doc_id`` get different
    slots of one shard. Other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.col("doc_id")
    rows = stored(
        documents(docs, "doc_id", "text").select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            place(key, tree).alias("shard"),
            place(key, grown(tree)).alias("grown_shard"),
        ),
        "sized",
    )
    chunks = max(1, -(-rows.count() // (CHUNK_ROWS * len(tree))))
    dealt = rows.withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(chunks)).cast("int")
    )
    before = (
        dealt.groupBy("shard", "chunk")
        .agg(F.count(F.lit(1)).alias("rows"))
        .selectExpr(
            "shard", "chunk",
            "sum(rows) OVER (PARTITION BY shard ORDER BY chunk) - rows AS before",
        )
    )
    return (
        dealt.join(before, ["shard", "chunk"])
        .selectExpr(
            "doc_id", "size", "text_crc32", "shard", "grown_shard",
            "before + row_number() OVER (PARTITION BY shard, chunk ORDER BY doc_id, text_crc32, size) - 1 AS slot",
        )
    )
