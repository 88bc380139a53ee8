"""Document measures against plain Python, and the verdicts on hosts."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from lendmill.llm.host_rules import host_rules, host_verdicts, measured

SCHEMA = "doc_id long, text string, source string"
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if times[r] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))


def failed(m):
    return m[0] < 10 or 100 * m[4] > 20 * m[0]


def test_whole_table(spark, documents):
    rows = {r["doc_id"]: r["text"] for r in documents.collect()}
    found = host_rules(documents).collect()
    assert {r["doc_id"]: tuple(r[n] for n in NAMES) for r in found} == {d: brute(t) for d, t in rows.items()}
    assert all(r["base_failed"] == failed(brute(rows[r["doc_id"]])) for r in found)
    assert len(found) == len(rows)


def test_edges(spark):
    rng = random.Random(1)
    texts = [
        None, "", " \t\n\x0b\x0c\r ", "one", "a b c d e", "a b c d e a b c d e", "a a a a a a a",
        "x\nx\n\n \n x\nx ", "#*$%&|<> é😀   x", "a b c d e f\na b c d e f\n",
        " ".join(rng.choice("abc") for _ in range(40_000)), "w " * 30_000,
        *(" ".join(rng.choice("abcd") for _ in range(rng.randint(4, 60))) for _ in range(300)),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df = df.withColumn("_n", F.lit("clash")).withColumn("h", F.lit(1))
    found = {r["doc_id"]: r for r in measured(df.drop("_n")).collect()}
    for i, t in enumerate(texts):
        assert tuple(found[i][n] for n in NAMES) == brute(t), i
    assert host_rules(df.withColumn("source", F.lit("s"))).count() == len(texts)


def test_hosts_are_shrunk_and_joined_back(spark):
    good = " ".join(f"w{i}" for i in range(20))
    rows = [(i, good, f"good{i % 40}") for i in range(400)]
    rows += [(1000 + i, "bad" if i < 180 else good, "awful") for i in range(200)]
    rows += [(2000, "bad", "small"), (2001, good, "small"), (2002, "bad", "tiny"), (2003, good, None), (2003, good, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = host_rules(df)
    verdicts = {r["host"]: r for r in host_verdicts(found.select("host", "base_failed")).collect()}
    assert verdicts["awful"]["rejected"] and not verdicts["good1"]["rejected"]
    assert 0.3 < verdicts["small"]["rate"] < 0.5 < verdicts["tiny"]["rate"] < 1
    kept = {}
    for r in found.collect():
        kept.setdefault(r["host"], []).append(r["kept"])
    assert not any(kept["awful"]) and all(kept["good1"]) and sorted(kept["small"]) == [False, True]
    assert kept[None] == [True, True]


def test_empty_table(spark):
    assert host_rules(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python_in_the_plan(spark, documents):
    assert "Python" not in measured(documents)._jdf.queryExecution().executedPlan().toString()
