"""Spelling variants against brute force, with the rules written down anew."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lendmill.llm.spelling import near_words, spelling_variants

SCHEMA = "doc_id long, text string"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x7f" else c for c in run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [o for o in words if abs(len(o) - len(w)) < 2 and one_edit(w, o)] for w in words}
    forms = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= 10 * words[w]:
                forms[w] = best
    found = set()
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        found.add((w, form, root, n, len(near[w]), words[form] if form else None))
    return found


def rows_of(result):
    return [tuple(r) for r in result.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def made(seed, size):
    """Texts of few stems with one or two edits, capitals and letters beyond ASCII."""
    rnd = random.Random(seed)
    letters = "aeinrstéÉ×"
    stems = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(6, 11))) for _ in range(8)]
    rows = []
    for doc_id in range(size):
        words = []
        for _ in range(rnd.randrange(40)):
            word = stems[min(rnd.randrange(8), rnd.randrange(8))]
            for _ in range(rnd.choice([0, 0, 0, 1, 1, 2])):
                at = rnd.randrange(len(word) + 1)
                word = word[:at] + rnd.choice(["", rnd.choice(letters)]) + word[at + rnd.randrange(2) :]
            words.append(rnd.choice([word, word.upper(), word.title()]))
        rows.append((doc_id, rnd.choice([" ", ", ", "-1-"]).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    rows = made(seed, 150)
    found = rows_of(spelling_variants(spark.createDataFrame(rows, SCHEMA)))
    assert len(found) == len(set(found))
    assert set(found) == brute(rows)
    assert any(form for _, form, *_ in found)


def test_documents_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.where(F.length("text") < 3000)
    wanted = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert set(rows_of(spelling_variants(docs))) == wanted


def test_chain_of_forms(spark):
    text = " ".join(["abcdefgx"] * 2 + ["abcdefgh"] * 40 + ["abcdefg"] * 500)
    found = {r[0]: r for r in rows_of(spelling_variants(spark.createDataFrame([(None, text)], SCHEMA)))}
    # The most frequent near word is the form, so both lead to the shortest at once.
    assert found["abcdefgx"] == ("abcdefgx", "abcdefg", "abcdefg", 2, 2, 500)
    text = " ".join(["abcdexyh"] * 2 + ["abcdexgh"] * 40 + ["abcdefgh"] * 500)
    found = {r[0]: r for r in rows_of(spelling_variants(spark.createDataFrame([(None, text)], SCHEMA)))}
    assert found["abcdexyh"] == ("abcdexyh", "abcdexgh", "abcdefgh", 2, 1, 40)
    assert found["abcdefgh"] == ("abcdefgh", None, "abcdefgh", 500, 1, None)


def test_chunks_and_very_long_words(spark, monkeypatch):
    """Blocks cut into many chunks, words beyond the base of the block numbers."""
    rnd = random.Random(3)
    words = {"".join(rnd.choice("aq") for _ in range(9)) for _ in range(200)}
    words |= {"a" * n for n in (63, 64, 65, 2500, 2501)} | {"a" * 2499 + "b"}
    rows = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    monkeypatch.setattr("lendmill.llm.spelling.CHUNK_LETTERS", 200)
    found = {(r.word, r.other) for r in near_words(rows).collect()}
    assert found == {(a, b) for a in words for b in words if abs(len(a) - len(b)) < 2 and one_edit(a, b)}


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (None, "lettered"), (None, "LETTERED lettere"), (3, "1234567 short")] * 2
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("word", F.lit(1)).withColumn("n", F.lit("x"))
    assert set(rows_of(spelling_variants(docs))) == brute(rows)
    assert spelling_variants(docs.limit(0)).count() == 0
