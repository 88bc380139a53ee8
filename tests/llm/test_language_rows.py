"""Language: rows without ``doc_id`` are judged like all others."""

from lendmill.llm.language import accepted
from tests.llm.test_language import SCHEMA


def test_rows_without_doc_id_are_judged_by_their_text(spark):
    rows = [(i, "the cat sat on the mat and more" if i % 2 else "der hund und die katze im haus", "en" if i % 2 else "de") for i in range(60)]
    rows += [(None, None, "en"), (None, "123 !!", "en"), (None, "the cat sat on the mat", "en")]
    kept = [r["text"] for r in accepted(spark.createDataFrame(rows, SCHEMA)).collect() if r["doc_id"] is None]
    assert kept == ["the cat sat on the mat"]
