"""No job may overwrite what it reads, however the paths are spelt."""

import pytest

from lendmill.operators import flatten_messages, histogram, synth_messages
from lendmill.plans import run_call_snapshot, run_dashboard, run_flatten_batch, run_flatten_stream, run_loan_batch
from lendmill.schemas import FLAT
from lendmill.sources import MessageDir, read_messages


def content(path):
    return {p: p.read_bytes() for p in path.rglob("*") if p.is_file()}


@pytest.fixture
def messages(spark, tmp_path):
    synth_messages(spark.range(20)).write.text(str(tmp_path / "messages"))
    return tmp_path / "messages"


@pytest.mark.parametrize("flat", ["{0}", "{0}/below", "file:{0}", "{0}/../messages/./", "file://{0}/x/.."])
def test_flatten_does_not_delete_its_messages(spark, messages, flat):
    before = content(messages)
    source, path = MessageDir(str(messages)), flat.format(messages)
    for job in (
        lambda: run_flatten_batch(spark, source, path),
        lambda: run_flatten_batch(spark, source, str(messages.parent / "flat"), path),
        lambda: run_flatten_stream(spark, source, path, str(messages.parent / "checkpoint")),
        lambda: run_flatten_stream(spark, source, str(messages.parent / "flat"), path),
    ):
        with pytest.raises(ValueError, match="same path or nested"):
            job()
    assert content(messages) == before


def test_extract_below_the_flat_table_is_refused(spark, messages):
    flat = str(messages.parent / "flat")
    with pytest.raises(ValueError):
        run_flatten_batch(spark, MessageDir(str(messages)), flat, f"{flat}/extract")


@pytest.mark.parametrize("name", ["risk_share", "base", "decision_count/below", "."])
def test_dashboard_does_not_replace_its_flat_table(spark, messages, name):
    flat = messages.parent / "out" / name
    flatten_messages(read_messages(spark, MessageDir(str(messages)))).write.parquet(str(flat))
    before = content(flat)
    with pytest.raises(ValueError):
        run_dashboard(spark, f"file:{flat}", str(messages.parent / "out"))
    assert content(flat) == before and spark.read.parquet(str(flat)).columns == FLAT.names


def test_loan_batch_and_snapshot_do_not_delete_their_input(spark, tmp_path):
    clean = tmp_path / "out" / "clean"
    clean.mkdir(parents=True)
    (clean / "a.csv").write_text("x\n")
    (tmp_path / "link").symlink_to(clean)
    for source in (f"file:{clean}", str(tmp_path / "link")):
        with pytest.raises(ValueError):
            run_loan_batch(spark, source, str(tmp_path / "out"), "2026-01-01")
        with pytest.raises(ValueError):
            run_call_snapshot(spark, source, str(clean))
    assert (clean / "a.csv").read_text() == "x\n"


def test_histogram_of_odd_numbers(spark):
    rows = [(0.5,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,), (-0.5,), (12.0,)]
    df = spark.createDataFrame(rows, "v double")
    assert {r["bin"]: r["cnt"] for r in histogram(df, "v", 10).collect()} == {0: 1, -10: 1, 10: 1, None: 4}
    large = 2**62 + 12
    longs = spark.createDataFrame([(large,), (large + 1,), (-1,), (None,)], "v long")
    assert {r["bin"]: r["cnt"] for r in histogram(longs, "v", 10).collect()} == {large - large % 10: 2, -10: 1, None: 1}
