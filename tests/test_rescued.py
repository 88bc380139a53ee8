"""Values of messages that have no place in the flat table."""

import pytest

from lendmill.operators import flatten_messages
from lendmill.sources import MessageDir
from lendmill.streaming import read_message_stream, stream_result, write_stream

GOOD = '{"application_id":"a","loan":{"amount":1,"term_months":null},"documents":[{"type":"p"}]}'
ODD = (
    '{"application_id":7,"loan":{"amount":1.5,"term_months":3000000000,"x":[1]},"scoring":7,'
    '"documents":[{"type":"p","status":{"a":1},"q":null},3,null],"z.z":true,"loan.amount":0}'
)


def flat(spark, *bodies, **options):
    df = spark.createDataFrame([(b,) for b in bodies], "value string")
    return flatten_messages(df, rescued_column="rescued", **options)


def test_all_that_fits_is_as_without_rescue(spark):
    bodies = [GOOD, '{"documents":[]}', '{"documents":null,"scoring":{"score":5,"risk_level":"low"}}', "{}", None]
    found = flat(spark, *bodies)
    assert found.where("rescued is not null").count() == 0
    plain = flatten_messages(spark.createDataFrame([(b,) for b in bodies], "value string"))
    assert sorted(map(str, found.drop("rescued").collect())) == sorted(map(str, plain.collect()))


def test_misfits_and_strangers(spark):
    first, second, third = flat(spark, ODD).collect()
    common = {
        "loan.amount": "1.5", "loan.term_months": "3000000000", "loan.x": "[1]", "scoring": "7",
        "`z.z`": "true", "`loan.amount`": "0",
    }
    assert first.rescued == common | {"documents[].status": '{"a":1}', "documents[].q": "null"}
    assert second.rescued == common | {"documents[]": "3"}
    assert third.rescued == common
    # A single value of another kind fits text.
    assert (first.application_id, first.doc_type, first.loan_amount) == ("7", "p", None)


@pytest.mark.parametrize("body", ["", " ", "not json", "[1,2]", "null", "5", '{"a":1', '{"a":1,"a":2}'])
def test_bodies_that_are_no_objects(spark, body):
    (row,) = flat(spark, body).collect()
    assert row.rescued == {"$": body}
    assert not any(v for k, v in row.asDict().items() if k != "rescued")


def test_array_of_another_kind(spark):
    (row,) = flat(spark, '{"documents":{"type":"p"}}').collect()
    assert row.rescued == {"documents": '{"type":"p"}'}


def test_parsed_once_and_columns(spark):
    found = flat(spark, ODD, columns=["score", "doc_type"])
    assert found.columns == ["score", "doc_type", "rescued"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().count("parsejson") == 1
    with pytest.raises(ValueError, match="rescued"):
        flat(spark, ODD, corrupt_column="raw")


def test_blank_body_keeps_its_text_as_corrupt(spark):
    df = spark.createDataFrame([("",), (" ",), ("x",), (GOOD,)], "value string")
    found = flatten_messages(df, corrupt_column="raw").select("raw").collect()
    assert [r.raw for r in found] == ["", " ", "x", None]


def test_stream_rescues_alike(spark, tmp_path):
    source = MessageDir(str(tmp_path / "in"))
    lines = [GOOD, ODD, "not json"]
    spark.createDataFrame([(b,) for b in lines], "value string").write.text(source.path)
    path = str(tmp_path / "out")
    write_stream(
        flatten_messages(read_message_stream(spark, source), rescued_column="rescued"),
        path, str(tmp_path / "checkpoint"),
    )
    batch = flat(spark, *lines)
    assert sorted(map(str, stream_result(spark, path, "rescued_flat").collect())) == sorted(map(str, batch.collect()))
