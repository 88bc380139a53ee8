"""CSV that keeps every text, and lines that do not parse."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendmill.plans import run_loan_batch
from lendmill.plans.loan_batch import MalformedInput
from lendmill.schemas import APPLICATIONS
from lendmill.sinks import snapshot_table
from lendmill.sources import read_csv_dir, read_parquet_table
from lendmill.sources.files import escaped, unescaped

ODD = ["", None, "\\N", "\\\\N", "\\", "\\n", "a\nb", "\r\n", "\\\n\\", ' "quoted", ', "x,y", "\\r\\\\n", "\\x"]
SCHEMA = "id int, text string, other string"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.none() | st.text('\\nrN\n\r", é', max_size=8), max_size=20))
def test_escapes_go_both_ways(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *ODD])], "id int, text string")
    lines = rows.withColumn("line", escaped(F.col("text")))
    assert lines.where(F.col("line").rlike("[\n\r]")).count() == 0
    assert lines.where(~unescaped(F.col("line")).eqNullSafe(F.col("text"))).count() == 0


def test_every_text_comes_back_from_split_files(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [(i if i % 7 else None, t, o) for i, (t, o) in enumerate([(t, o) for t in ODD for o in ODD] * 20)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    snapshot_table(df, path, lossless=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        read = read_csv_dir(spark, path, df.schema, lossless=True)
        assert read.rdd.getNumPartitions() > 3
        assert sorted(map(str, read.collect())) == sorted(map(str, df.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def write(folder, *lines):
    folder.mkdir()
    (folder / "part.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_rejected_lines(spark, tmp_path):
    path = write(tmp_path / "in", "id,text,other", "1,a,b", "1 2,a,b", "3,a", "4,a,b,c", "5,,", ",x,y", '6,"a"b,c')
    read = read_csv_dir(spark, path, spark.createDataFrame([], SCHEMA).schema, rejected="_line")
    found = {r.id or r.text: r._line for r in read.where("_line is not null or id is not null").collect()}
    assert found[1] is None and found[5] is None
    assert found["a"] == "1 2,a,b" and found[3] == "3,a" and found[4] == "4,a,b,c"
    # Any selection of columns sees the same lines.
    assert read.select("text", "_line").where("_line is not null").count() >= 3
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_csv_dir(spark, path, spark.createDataFrame([], SCHEMA).schema, fail_fast=True).collect()
    with pytest.raises(ValueError, match="schema"):
        read_csv_dir(spark, path, rejected="_line")


HEADER = ",".join(APPLICATIONS.names)
GOOD = "a1,2026-06-16T10:00:00.000Z,c,R,p,10.5,12,700,low,approved,10,web,true,5"


def test_loan_batch_counts_and_keeps_malformed_lines(spark, tmp_path):
    bad = GOOD.replace("700", "7 00").replace("a1", "a2")
    source, output = write(tmp_path / "in", HEADER, GOOD, bad, "a3"), str(tmp_path / "out")
    result = run_loan_batch(spark, source, output, "2026-06-16")
    assert (result.loaded, result.total, result.malformed) == (3, 3, 2)
    lines = read_parquet_table(spark, result.rejected_path).collect()
    assert sorted(r.line for r in lines) == [bad, "a3"]
    scores = {r.application_id: r.credit_score for r in read_parquet_table(spark, f"{output}/clean").collect()}
    assert scores == {"a1": 700, "a2": None, "a3": None}


def test_loan_batch_beyond_the_tolerance_changes_nothing(spark, tmp_path):
    output = str(tmp_path / "out")
    good = run_loan_batch(spark, write(tmp_path / "one", HEADER, GOOD), output, "2026-06-16", most_malformed=0)
    assert good.malformed == 0 and good.rejected_path is None
    source = write(tmp_path / "two", HEADER, GOOD, "a2", "a3")
    with pytest.raises(MalformedInput, match="2 lines"):
        run_loan_batch(spark, source, output, "2026-06-16", most_malformed=1)
    assert read_parquet_table(spark, f"{output}/clean").count() == 1
    assert run_loan_batch(spark, source, output, "2026-06-16", most_malformed=2).total == 3
