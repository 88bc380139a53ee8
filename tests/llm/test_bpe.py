"""Byte-level BPE against the tokenizers library, and back to the texts."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendmill.llm.bpe import bpe_digests, coder, decoded, encoded
from lendmill.llm.queries import BYTE_TOKENIZER, tokenizer_path

SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def path():
    return tokenizer_path(BYTE_TOKENIZER)


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from([SPECIAL, "'s", "  ", "\n\n", "abab", "é"]))))
def test_any_text(path, library, parts):
    text = "".join(parts).encode("utf-8", "replace").decode()
    ids = coder(path).encode(text)
    assert ids.tolist() == ids_of(library, text)
    assert coder(path).decode(ids) == text


def test_letters_numbers_and_blanks_of_every_plane(path, library):
    """Each 7th character, and all around the additions of the last Unicode versions."""
    codes = {*range(0, 0x110000, 7), *range(0x88A, 0x898), *range(0x13450, 0x14400, 3), *range(0x10930, 0x10960)}
    for low in range(0, 0x110000, 0x800):
        some = [chr(c) for c in range(low, low + 0x800) if c in codes and not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}1{c} {c}'s\n" for c in some)
        assert coder(path).encode(text).tolist() == ids_of(library, text), hex(low)


def test_long_piece_merges_like_the_library(path, library):
    rnd = random.Random(5)
    for text in ("a" * 50_000, "".join(rnd.choice("theinrs") for _ in range(50_000))):
        assert coder(path).encode(text).tolist() == ids_of(library, text)


def test_any_ids_decode_like_the_library(path, library):
    rnd = np.random.default_rng(2)
    for _ in range(500):
        ids = rnd.integers(0, 50257, 9)
        assert coder(path).decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_digests_of_the_tables(spark, path, library, documents):
    found = {r.doc_id: r for r in bpe_digests(documents, path).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for doc_id, text in rows:
        ids = ids_of(library, text or "")
        row = found[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_edge_rows(spark, path):
    rows = [(None, "abc"), (1, None), (2, ""), (2, ""), (3, SPECIAL), (4, "x y " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("IDS", F.lit("taken"))
    found = encoded(docs, path)
    assert found.columns == ["doc_id", "text", "ids"]
    assert {r.text: list(r.ids) for r in found.where("text != 'abc' or text is null").collect()}[SPECIAL] == [50256]
    assert found.where("text is null").first().ids == []
    back = decoded(found, path).where("not (decoded <=> coalesce(text, ''))")
    assert back.count() == 0
    odd = spark.createDataFrame([([50257, -1, None, 64],), (None,)], "ids array<int>")
    assert [r.decoded for r in decoded(odd, path).collect()] == ["a", ""]
    digests = bpe_digests(docs, path).collect()
    assert len(digests) == len(rows) and [r.n_tokens for r in digests if r.doc_id == 2] == [0, 0]
    assert bpe_digests(docs.limit(0), path).count() == 0


def test_other_kinds_are_refused(path):
    with pytest.raises(ValueError, match="byte-level"):
        coder(tokenizer_path())
