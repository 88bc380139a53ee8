"""Quality rules per document and per host, with built-in functions only.

Each document is measured over its whole text. Failures of the document rules are added
up by host, and the rate of each host is shrunk by a beta prior that is fitted to all
hosts, so that a host with few documents is not judged by them alone. A host whose shrunk
rate is too high takes its other documents with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.tables import stored

WINDOW = 5
LEAST_WORDS = 10
#: More repeated words than this, in percent, fail a document.
MOST_REPEATED = 20
#: A host with a higher shrunk rate of failing documents is rejected.
MOST_FAILING = 0.5

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _shifted(array: str, by: int, length: Column) -> Column:
    return F.slice(array, F.lit(1 + by), F.greatest(length, F.lit(0)))


def _pairs(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda x, y: F.xxhash64(x, y))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words`` (long) and ``base_failed``; a null text counts as empty.

    Repeated windows are found by sorting the hashes of all windows of a text together
    with their places, only for texts in which some hash comes twice.
    """
    names = docs.columns
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: _without(x, _SPACE) != "")
    n = F.col("_n")
    count = F.size("_windows")
    places = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    before = F.zip_with(
        "_sorted", F.concat(none, F.slice("_sorted", F.lit(1), count - 1)),
        lambda x, y: F.struct(x["h"].alias("h"), x["i"].alias("i"), (x["h"].eqNullSafe(y["h"])).alias("same")),
    )
    repeated = F.zip_with(
        "_before", F.concat(F.slice("_sorted", F.lit(2), count - 1), none),
        lambda x, y: F.when(x["same"] | x["h"].eqNullSafe(y["h"]), x["i"]),
    )
    at = F.size("_at")
    steps = F.zip_with(
        F.slice("_at", F.lit(1), at - 1), F.slice("_at", F.lit(2), at - 1),
        lambda x, y: F.least(y - x, F.lit(WINDOW)),
    )
    covered = F.aggregate(steps, F.lit(WINDOW), lambda total, x: total + x)
    return (
        docs.select(
            *(F.col(f"`{c}`") for c in names),
            F.length(_without(whole, _SPACE)).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(_without(whole, _SYMBOLS))).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.transform(
                F.filter(F.split(whole, r"[\x20\x09-\x0D]+"), lambda w: w != ""),
                lambda w: F.xxhash64(w),
            ).alias("_words"),
        )
        .withColumn("_n", F.size("_words"))
        .withColumn("_two", _pairs(_shifted("_words", 0, n - 1), _shifted("_words", 1, n - 1)))
        .withColumn("_four", _pairs(_shifted("_two", 0, n - 3), _shifted("_two", 2, n - 3)))
        .withColumn("_windows", _pairs(_shifted("_four", 0, n - 4), _shifted("_words", 4, n - 4)))
        .withColumn("_some", F.size(F.array_distinct("_windows")) < count)
        .withColumn("_sorted", F.when(F.col("_some"), F.sort_array(places)))
        .withColumn("_before", F.when(F.col("_some"), before))
        .withColumn("_at", F.when(F.col("_some"), F.sort_array(F.filter(repeated, lambda i: i.isNotNull()))))
        .select(
            *(F.col(f"`{c}`") for c in names),
            n.cast("long").alias("n_words"),
            "word_chars", "n_symbols", "n_dup_lines",
            F.when(F.col("_some"), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        )
        .withColumn(
            "base_failed",
            (F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
        )
    )


def host_verdicts(measures: DataFrame, host: str = "host") -> DataFrame:
    """``host``, ``n``, ``failed``, ``rate``, ``rejected`` for each host that is not null.

    The prior has the mean of all documents, and the spread between the hosts' rates that
    is left when the spread by chance is taken off.
    """
    hosts = stored(
        measures.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")),
        "hosts",
    )
    total = hosts.agg(
        (F.sum("failed") / F.sum("n")).alias("mean"),
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("hosts"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("squares"),
    ).first()
    mean = total["mean"] or 0.0
    chance = mean * (1 - mean)
    between = 0.0
    if total["n"]:
        between = max(0.0, (total["squares"] - total["n"] * mean * mean - total["hosts"] * chance) / total["n"])
    weight = max(0.0, chance / between - 1) if between > 0 else float(total["n"] or 0) + 1
    rate = (F.col("failed") + mean * weight) / (F.col("n") + weight)
    return hosts.withColumn("rate", rate).withColumn("rejected", F.col("rate") > MOST_FAILING)


def host_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """``doc_id``, ``host``, the measures, ``base_failed``, ``host_rate`` and ``kept`` for each row.

    A row without host is judged by its own measures only; its ``host_rate`` is null.
    """
    rows = docs.select("doc_id", "text", F.col(f"`{host}`").cast("string").alias("host"))
    found = stored(measured(rows).drop("text"), "measures")
    verdicts = host_verdicts(found).select("host", F.col("rate").alias("host_rate"), "rejected")
    return (
        found.join(verdicts, "host", "left")
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False)))
        .drop("rejected")
    )
