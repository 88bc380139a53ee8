"""Tables that change by whole versions: safe refreshes and upserts of the touched parts only."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lendmill.plans import run_keyed_upsert
from lendmill.sinks import read_keyed_table, refresh_table, upsert_keyed_table, write_keyed_table
from lendmill.sources import read_parquet_table, table_path
from lendmill.versions import ConcurrentCommit, Versions


def failing(spark, rows):
    """A table whose last task fails for good."""
    broken = F.when(F.col("id") == rows - 1, F.raise_error(F.lit("task lost"))).otherwise(F.col("id"))
    return spark.range(0, rows, 1, 4).select(broken.cast("long").alias("id"))


def ids(df):
    return sorted(r[0] for r in df.collect())


def data_files(root):
    """Each Parquet file below the root with its digest."""
    found = root.rglob("*.parquet")
    return {str(f.relative_to(root)): hashlib.sha256(f.read_bytes()).hexdigest() for f in found}


def test_failing_refresh_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "t")
    assert refresh_table(spark.range(10), root)["rows"] == 10
    reader = read_parquet_table(spark, root)
    with pytest.raises(Exception, match="task lost"):
        refresh_table(failing(spark, 1000), root)
    assert ids(read_parquet_table(spark, root)) == list(range(10))
    assert refresh_table(spark.range(20), root, files=2)["rows"] == 20
    # Who began before the refresh still sees the whole version before.
    assert ids(reader) == list(range(10))
    assert ids(read_parquet_table(spark, root)) == list(range(20))


def test_first_refresh_that_fails_leaves_no_table(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(Exception, match="task lost"):
        refresh_table(failing(spark, 10), root)
    assert Versions(spark, root).current() is None


def test_old_versions_and_failed_runs_are_removed(spark, tmp_path):
    root = tmp_path / "t"
    for n in range(1, 6):
        refresh_table(spark.range(n), str(root))
        with pytest.raises(Exception, match="task lost"):
            refresh_table(failing(spark, 100), str(root))
    refresh_table(spark.range(7), str(root))
    versions = Versions(spark, str(root))
    assert versions.commits() == [5, 6]
    assert len([d for d in root.iterdir() if d.name.startswith("version-")]) == 2
    assert ids(read_parquet_table(spark, str(root))) == list(range(7))


def test_second_writer_raises(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "t"))
    versions.commit(1, {"parts": []})
    with pytest.raises(ConcurrentCommit, match="another run"):
        versions.commit(1, {"parts": []})
    assert versions.children("_commits") == ["0000000001.json"]


def test_plain_table_is_read_and_then_refreshed(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.range(3).write.parquet(root)
    assert table_path(spark, root) == root
    assert ids(read_parquet_table(spark, root)) == [0, 1, 2]
    refresh_table(spark.range(5), root)
    assert ids(read_parquet_table(spark, root)) == [0, 1, 2, 3, 4]
    assert ids(spark.read.parquet(table_path(spark, root))) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_small_upserts_leave_the_other_parts_as_they_are(spark, tmp_path, threshold):
    root = tmp_path / "t"
    write_keyed_table(spark.range(400).selectExpr("id AS k", "0 AS v"), str(root), ["k"], 8)
    state = {k: 0 for k in range(400)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for v in range(1, 6):
            before = Versions(spark, str(root)).current().content["parts"]
            files = data_files(root)
            keys = [v, v * 7, 1000 + v]
            batch = spark.createDataFrame([(k, v) for k in keys], "k long, v int")
            after = upsert_keyed_table(spark, str(root), batch).content["parts"]
            state |= dict.fromkeys(keys, v)
            changed = {part for part in after if after[part] != before.get(part)}
            assert 0 < len(changed) <= 3
            now = data_files(root)
            for part in after:
                inside = [f for f in now if f.startswith(after[part] + "/")]
                assert len(inside) == 1
                assert part in changed or now[inside[0]] == files[inside[0]]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.k: r.v for r in read_keyed_table(spark, str(root)).collect()} == state
    # What the two last versions do not need is gone.
    assert len(data_files(root)) <= 8 + 3


def test_upsert_reads_only_touched_parts(spark, tmp_path):
    root = tmp_path / "t"
    write_keyed_table(spark.range(100).selectExpr("id AS k", "'old' AS v"), str(root), ["k"], 10)
    batch = spark.sql("SELECT 5 AS k, 'new' AS v")
    touched = batch.select(F.pmod(F.xxhash64(F.col("k").cast("long")), F.lit(10))).first()[0]
    for part, directory in Versions(spark, str(root)).current().content["parts"].items():
        if part != str(touched):
            for file in (root / directory).iterdir():
                file.write_bytes(b"not to be read")
    upsert_keyed_table(spark, str(root), batch)
    part = Versions(spark, str(root)).current().content["parts"][str(touched)]
    found = {r.k: r.v for r in spark.read.parquet(str(root / part)).collect()}
    assert found.pop(5) == "new" and set(found.values()) <= {"old"}


def test_keys_of_several_columns_nulls_and_other_types(spark, tmp_path):
    root = str(tmp_path / "t")
    held = spark.createDataFrame([(1, "a", 1), (None, "a", 2), (1, None, 3)], "k int, bucket string, v int")
    write_keyed_table(held, root, ["k", "bucket"], 4)
    batch = spark.sql("SELECT * FROM VALUES (1L, 'a', 9L), (NULL, 'a', 8L), (2L, 'b', 7L) AS t(k, bucket, v)")
    upsert_keyed_table(spark, root, batch)
    found = read_keyed_table(spark, root)
    assert found.schema == held.schema
    assert {tuple(r) for r in found.collect()} == {(1, "a", 9), (None, "a", 8), (1, None, 3), (2, "b", 7)}


def test_failing_batch_changes_nothing(spark, tmp_path):
    root = tmp_path / "t"
    write_keyed_table(spark.range(50).selectExpr("id AS k", "'old' AS v"), str(root), ["k"], 4)
    before = Versions(spark, str(root)).current()
    repeated = spark.sql("SELECT * FROM VALUES (1L, 'a'), (1L, 'b') AS t(k, v)")
    with pytest.raises(Exception, match="key repeated"):
        upsert_keyed_table(spark, str(root), repeated)
    assert upsert_keyed_table(spark, str(root), repeated.limit(0)) == before
    assert Versions(spark, str(root)).current() == before
    with pytest.raises(ValueError, match="no keyed table"):
        upsert_keyed_table(spark, str(tmp_path / "none"), repeated)
    with pytest.raises(ValueError, match="not columns"):
        write_keyed_table(repeated, str(tmp_path / "none"), ["other"], 4)


def test_empty_table_and_job(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = spark.range(1).selectExpr("id AS k", "'x' AS v").schema
    run = dict(keys=["k"], schema=schema, buckets=4)
    assert run_keyed_upsert(spark, root, spark.createDataFrame([], schema), **run) == 0
    assert run_keyed_upsert(spark, root, spark.range(9).selectExpr("id AS k", "'x' AS v"), **run) == 9
    assert run_keyed_upsert(spark, root, spark.range(5, 12).selectExpr("id AS k", "'y' AS v"), **run) == 12
