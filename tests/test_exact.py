"""Sums of doubles that are the same for every order of the rows."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from lendmill.functions import exact_mean, exact_sum
from lendmill.operators import application_metrics, mean_by

SCHEMA = "k int, x double"


def bits(value):
    return None if value is None else struct.pack(">d", value)


def summed(df):
    return {r.k: (bits(r.s), bits(r.m)) for r in df.groupBy("k").agg(exact_sum("x").alias("s"), exact_mean("x").alias("m")).collect()}


def test_bit_equal_over_partitionings(spark):
    rnd = random.Random(1)
    data = [(rnd.randrange(3), rnd.uniform(-1, 1) * 10 ** rnd.randrange(-9, 17)) for _ in range(20_000)]
    found = []
    for parts in (1, 7, 40):
        rnd.shuffle(data)
        df = spark.createDataFrame(data, SCHEMA).repartition(parts)
        found.append(summed(df))
    assert found[0] == found[1] == found[2]
    for k, (s, _) in found[0].items():
        wanted = math.fsum(x for key, x in data if key == k)
        assert struct.unpack(">d", s)[0] == pytest.approx(wanted, rel=1e-12)


def test_metrics_are_bit_equal_over_partitionings(spark):
    rnd = random.Random(2)
    data = [("r", rnd.random() < 0.5, rnd.uniform(0, 1e6), rnd.randrange(350, 900)) for _ in range(5000)]
    found = set()
    for parts in (1, 5, 16):
        rnd.shuffle(data)
        df = spark.createDataFrame(data, "region string, is_approved boolean, requested_amount double, credit_score int")
        row = application_metrics(df.repartition(parts), ["region"]).first()
        found.add((bits(row.avg_requested), bits(row.avg_score), row.approval_rate))
    assert len(found) == 1


@pytest.mark.parametrize(
    "values, wanted",
    [
        ([], None),
        ([None], None),
        ([0.1, 0.2, None], 0.30000000000000004),
        ([1e20, 1.0, -1e20], 1.0),
        ([-0.5, -0.25], -0.75),
        ([2.0**47 + 0.5, -(2.0**47)], 0.5),
        ([float("inf"), 1.0], math.inf),
        ([1e300, 1.0], 1e300),
        ([float("inf"), float("-inf")], math.nan),
        ([float("nan"), 1.0], math.nan),
    ],
)
def test_values(spark, values, wanted):
    df = spark.createDataFrame([(1, v) for v in values], SCHEMA)
    found = df.agg(exact_sum("x")).first()[0]
    if wanted is not None and math.isnan(wanted):
        assert math.isnan(found)
    elif wanted is None:
        assert found is None
    else:
        assert found == pytest.approx(wanted, rel=1e-13)


def test_whole_numbers_and_no_rows(spark):
    df = spark.range(10).selectExpr("'a' AS k", "id AS v")
    assert mean_by(df, "k", "v").first().mean == 4.5
    assert mean_by(df.where("v < 0"), "k", "v").count() == 0
    assert df.where("v < 0").agg(exact_mean("v")).first()[0] is None
