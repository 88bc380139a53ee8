"""Batch runs that go on where the last complete one stopped."""

import pytest
from pyspark.sql import functions as F

from lendmill.operators import flatten_messages
from lendmill.plans import read_increments, run_flatten_incremental
from lendmill.sinks import write_messages
from lendmill.sources import MessageDir
from lendmill.versions import Versions


def publish(spark, source, *names):
    bodies = [('{"application_id":"%s"}' % name,) for name in names]
    write_messages(spark.createDataFrame(bodies, "value string").coalesce(1), source)


def names(spark, path):
    return sorted(r.application_id for r in read_increments(spark, path).collect())


@pytest.fixture
def places(tmp_path):
    return MessageDir(str(tmp_path / "in")), str(tmp_path / "flat")


def test_each_run_takes_what_is_new(spark, places):
    source, path = places
    assert read_increments(spark, path).count() == 0
    publish(spark, source, "a", "b")
    assert run_flatten_incremental(spark, source, path) == 2
    assert run_flatten_incremental(spark, source, path) == 0
    publish(spark, source, "c")
    publish(spark, source, "a")
    assert run_flatten_incremental(spark, source, path) == 2
    assert names(spark, path) == ["a", "a", "b", "c"]
    publish(spark, source, "d")
    assert run_flatten_incremental(spark, source, path) == 1
    assert names(spark, path) == ["a", "a", "b", "c", "d"]


def test_run_cut_off_after_some_rows(spark, places):
    source, path = places
    publish(spark, source, "a")
    run_flatten_incremental(spark, source, path)
    publish(spark, source, "b", "c")

    def late(messages):
        lost = F.raise_error(F.lit("cut off")).cast("string")
        name = F.when(F.col("application_id") == "c", lost).otherwise(F.col("application_id"))
        return flatten_messages(messages).withColumn("application_id", name)

    for _ in range(2):
        with pytest.raises(Exception, match="cut off"):
            run_flatten_incremental(spark, source, path, late)
    assert names(spark, path) == ["a"]
    publish(spark, source, "d")
    assert run_flatten_incremental(spark, source, path) == 3
    assert names(spark, path) == ["a", "b", "c", "d"]
    # The directories of the runs that were cut off are gone.
    versions = Versions(spark, path)
    assert sorted(d for d in versions.children() if d.startswith("version-")) == sorted(versions.current().parts)


def test_crash_between_rows_and_commit(spark, places, monkeypatch):
    source, path = places
    publish(spark, source, "a")
    monkeypatch.setattr(Versions, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError, match="driver lost"):
        run_flatten_incremental(spark, source, path)
    monkeypatch.undo()
    assert run_flatten_incremental(spark, source, path) == 1
    assert names(spark, path) == ["a"]


def test_same_paths_are_refused(spark, places):
    source, _ = places
    with pytest.raises(ValueError, match="same path"):
        run_flatten_incremental(spark, source, source.path + "/flat")
