"""Connected groups of nodes that share buckets, without all pairs of a bucket.

A bucket may hold a large part of all nodes, mostly because these are variants of one
thing and link with one another. So first each node is only paired with a few hubs of its
buckets, which is linear in the memberships and joins such variants to few groups. This
is done ``rounds`` times, each with other hubs. Then all pairs of nodes that share a bucket, but are not yet in one
group, are checked: no link between two groups is lost, and pairs inside a group are
never made.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.tables import stored

HUBS = 3
ROUNDS = 2

Condition = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def _side(prefix: str) -> Callable[[str], Column]:
    return lambda name: F.col(f"{prefix}_{name}")


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{prefix}_{c}") for c in df.columns))


def connected(
    members: DataFrame,
    possible: Condition,
    verify: Callable[[DataFrame], DataFrame],
    hubs: int = HUBS,
    rounds: int = ROUNDS,
    once: bool = False,
    enough: int | None = None,
) -> DataFrame:
    """``node``, ``component`` (smallest node) for each node that has a link.

    ``members`` has ``node`` (long), ``bucket`` and further columns, one row per node
    and bucket. ``possible`` is a cheap necessary condition on the columns of two rows.
    ``verify`` gets distinct pairs ``a < b`` and returns those that link. With ``once`` the
    pairs are stored before and those that the hubs made not verified again: it pays where
    most pairs do not link. With ``enough`` only pairs are verified whose common buckets have
    that ``weight`` together, a column of ``members`` that is the same for all of a bucket.
    """
    spark = members.sparkSession
    members = stored(members, "members")
    groups = spark.createDataFrame([], "node long, component long")
    labelled = _labelled(members, groups)
    verified: list[DataFrame] = []
    for turn in range(rounds):
        pairs = _distinct(_hub_pairs(labelled, possible, turn * hubs, hubs), enough)
        pairs = _unseen(pairs, verified)
        if once:
            pairs = stored(pairs, "pairs")
            verified.append(pairs)
        groups = _merged(groups, stored(verify(pairs), "links"))
        labelled = stored(_labelled(members, groups), "labelled")
    split = (
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("bucket")
    )
    rest = stored(labelled.join(split, "bucket", "left_semi"), "split-members")
    a, b = _side("a"), _side("b")
    across = _named(rest, "a").join(
        _named(rest, "b"),
        (a("bucket") == b("bucket")) & (a("component") < b("component")) & possible(a, b),
    )
    pairs = _unseen(_distinct(across, enough), verified)
    if once:
        pairs = stored(pairs, "pairs")
    return _merged(groups, stored(verify(pairs), "links"))


def _unseen(pairs: DataFrame, verified: list[DataFrame]) -> DataFrame:
    for earlier in verified:
        pairs = pairs.join(earlier, ["a", "b"], "left_anti")
    return pairs


def _labelled(members: DataFrame, groups: DataFrame) -> DataFrame:
    return members.join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )


def _merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """The groups after these links between nodes of different groups."""
    group_of = lambda side: groups.select(
        F.col("node").alias(side), F.col("component").alias(f"{side}_group")
    )
    between = (
        links.join(group_of("a"), "a", "left")
        .join(group_of("b"), "b", "left")
        .select(F.coalesce("a_group", "a").alias("a"), F.coalesce("b_group", "b").alias("b"))
    )
    merged = components(between)
    outer = merged.select(F.col("node").alias("component"), F.col("component").alias("outer"))
    return stored(
        groups.join(outer, "component", "left")
        .select("node", F.coalesce("outer", "component").alias("component"))
        .unionByName(merged.join(groups, "node", "left_anti")),
        "components",
    )


def _hub_pairs(labelled: DataFrame, possible: Condition, seed: int, hubs: int) -> DataFrame:
    """Each member with those of its bucket whose hashes by some seeds are smallest, if
    these are of another group."""
    row = F.struct(*labelled.columns)
    names = [f"hub{k}" for k in range(hubs)]
    chosen = labelled.groupBy("bucket").agg(
        *(
            F.min_by(row, F.xxhash64("node", F.lit(seed + k))).alias(name)
            for k, name in enumerate(names)
        )
    )
    hub = chosen.select(F.explode(F.array_distinct(F.array(*names))).alias("h")).select("h.*")
    a, b = _side("a"), _side("b")
    return _named(hub, "a").join(
        _named(labelled, "b"),
        (a("bucket") == b("bucket")) & (a("component") != b("component")) & possible(a, b),
    )


def _distinct(pairs: DataFrame, enough: int | None = None) -> DataFrame:
    a, b = F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")
    if enough is None:
        return pairs.select(a, b).distinct()
    weighed = pairs.groupBy(a, b).agg(F.sum("a_weight").alias("weight"))
    return weighed.where(F.col("weight") >= enough).drop("weight")


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for each node of ``a``, ``b`` links.

    Each round hangs every group on its smallest neighbour below it, follows these
    parents to their ends and keeps the links between the groups that are left, at most
    half as many groups each time.
    """
    spark = links.sparkSession
    edges = stored(_edges(links), "edges")
    found = spark.createDataFrame([], "node long, component long")
    while not edges.isEmpty():
        parents = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
        parents = _flattened(stored(parents, "parents"))
        up = parents.select(F.col("node").alias("component"), F.col("component").alias("top"))
        found = stored(
            found.join(up, "component", "left")
            .select("node", F.coalesce("top", "component").alias("component"))
            .unionByName(parents),
            "found",
        )
        ends = lambda side: up.select(
            F.col("component").alias(side), F.col("top").alias(f"{side}_top")
        )
        edges = stored(
            _edges(
                edges.join(ends("a"), "a", "left")
                .join(ends("b"), "b", "left")
                .select(F.coalesce("a_top", "a").alias("a"), F.coalesce("b_top", "b").alias("b"))
            ),
            "edges",
        )
    roots = found.select(F.col("component").alias("node"), "component").distinct()
    return found.unionByName(roots)


def _edges(links: DataFrame) -> DataFrame:
    return (
        links.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _flattened(parents: DataFrame) -> DataFrame:
    """Follow parents, doubling the step each time, until no parent has a parent."""
    while True:
        up = parents.select(F.col("node").alias("component"), F.col("component").alias("top"))
        if parents.join(up, "component", "left_semi").isEmpty():
            return parents
        parents = stored(
            parents.join(up, "component", "left").select(
                "node", F.coalesce("top", "component").alias("component")
            ),
            "parents",
        )
