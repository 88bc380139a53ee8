import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType

from lendmill.functions.layout import layout_schema, narrow_layout
from lendmill.operators import flatten_messages, pack_messages, synth_applications, synth_messages
from lendmill.operators.messages import REGIONS
from lendmill.plans import run_publish
from lendmill.schemas import FLAT, MESSAGE, MESSAGE_LAYOUT, table
from lendmill.sinks import write_messages
from lendmill.sources import MessageDir, Topic, read_messages

MESSAGES = 100_000


@pytest.fixture(scope="module")
def bodies(spark):
    return synth_messages(spark.range(MESSAGES)).cache()


@pytest.fixture(scope="module")
def flat(bodies):
    return flatten_messages(bodies).cache()


def one(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_message_schema():
    assert MESSAGE.simpleString() == (
        "struct<application_id:string,customer:struct<customer_id:string,region:string>,"
        "loan:struct<amount:int,term_months:int>,scoring:struct<score:int,risk_level:string>,"
        "documents:array<struct<type:string,status:string>>,decision_status:string,submitted_at:string>"
    )


def test_sample_rows(flat):
    rows = {r["application_id"]: tuple(r)[1:10] for r in flat.collect()}
    assert rows["loan_0"] == ("cust_0", "DE-HE", 1000, 6, 350, "low", "passport", "verified", "approved")
    assert rows["loan_1"] == ("cust_1", "DE-BY", 1001, 7, 351, "medium", "passport", "pending", "rejected")
    assert rows["loan_2"] == (
        "cust_2", "DE-BE", 1002, 8, 352, "high", "passport", "rejected", "manual_review",
    )
    assert rows["loan_99999"] == (
        "cust_9", "FR-IDF", 2999, 13, 899, "low", "passport", "verified", "pending",
    )


def test_golden_totals(bodies, flat):
    assert flat.columns == FLAT.names
    assert bodies.agg(F.sum(F.length("value"))).first()[0] == 29_388_359
    assert tuple(
        flat.agg(
            F.count("*"),
            F.countDistinct("customer_id"),
            F.sum("loan_amount"),
            F.min("loan_amount"),
            F.max("loan_amount"),
            F.min("term_months"),
            F.max("term_months"),
            F.min("score"),
            F.max("score"),
        ).first()
    ) == (100_000, 9_999, 2_502_950_000, 1000, 49_999, 6, 63, 350, 999)


def test_golden_groups(flat):
    def counts(key):
        return {r[key]: r["count"] for r in flat.groupBy(key).count().collect()}

    assert counts("risk_level") == {"low": 33_334, "medium": 33_333, "high": 33_333}
    assert set(counts("decision_status").values()) == {25_000}
    assert counts("region") == dict.fromkeys(REGIONS, 12_500)
    assert counts("score") == {s: 154 if s < 900 else 153 for s in range(350, 1000)}
    means = {r["region"]: r["m"] for r in flat.groupBy("region").agg(F.avg("loan_amount").alias("m")).collect()}
    assert means == {region: 25_026 + i for i, region in enumerate(REGIONS)}


def test_pack_and_flatten_are_inverse(spark):
    flat = synth_applications(spark.range(1000))
    again = flatten_messages(pack_messages(flat))
    assert again.exceptAll(flat).count() == flat.exceptAll(again).count() == 0


def test_nulls_are_left_out_of_messages(spark):
    row = spark.createDataFrame([("a", None)], "application_id string, customer_id string")
    packed = pack_messages(row, {"application_id": "application_id", "customer": {"customer_id": "customer_id"}})
    assert json.loads(packed.first()["value"]) == {"application_id": "a", "customer": {}}


@pytest.mark.parametrize(
    "documents, wanted",
    [
        ('"documents":[{"type":"a","status":"x"},{"type":"b"}]', [("a", "x"), ("b", None)]),
        ('"documents":[]', [(None, None)]),
        ('"documents":null', [(None, None)]),
        ('"other":1', [(None, None)]),
        ('"documents":[null]', [(None, None)]),
    ],
)
def test_documents(spark, documents, wanted):
    rows = flatten_messages(one(spark, f'{{"application_id":"loan_1",{documents}}}')).collect()
    assert [(r["doc_type"], r["doc_status"]) for r in rows] == wanted
    assert {r["application_id"] for r in rows} == {"loan_1"}


@pytest.mark.parametrize("body", ["{bad json", '[{"application_id":"a"},{"application_id":"b"}]', "", "7"])
def test_bodies_of_another_shape_give_one_null_row(spark, body):
    rows = flatten_messages(one(spark, body)).collect()
    assert [tuple(r) for r in rows] == [(None,) * 11]


def test_null_body_is_dropped(spark):
    assert flatten_messages(one(spark, None, "{}")).count() == 1


@pytest.mark.parametrize(
    "loan, amount",
    [('"oops"', None), ("99999999999", None), ("1.5", None), ("15000", 15000)],
)
def test_wrong_types_spare_siblings(spark, loan, amount):
    body = f'{{"application_id":7,"loan":{{"amount":{loan},"term_months":12}},"scoring":{{"score":700}}}}'
    row = flatten_messages(one(spark, body)).first()
    assert (row["application_id"], row["loan_amount"], row["term_months"], row["score"]) == (
        "7", amount, 12, 700,
    )


def test_corrupt_column_splits_off_bad_bodies(spark):
    good, bad, half = '{"application_id":"a"}', "{bad json", '{"application_id":"b","loan":{"amount":"x"}}'
    rows = flatten_messages(one(spark, good, bad, half), corrupt_column="raw").collect()
    assert [(r["application_id"], r["raw"]) for r in rows] == [("a", None), (None, bad), ("b", half)]


def test_binary_bodies(spark):
    df = spark.createDataFrame([(b'{"application_id":"a"}',)], "value binary")
    assert flatten_messages(df).first()["application_id"] == "a"


def test_columns_keep_the_row_count(spark):
    body = '{"application_id":"a","customer":{"region":"R"},"documents":[{"type":"p"},{"type":"q"}]}'
    rows = flatten_messages(one(spark, body), columns=["region"]).collect()
    assert [tuple(r) for r in rows] == [("R",), ("R",)]
    rows = flatten_messages(one(spark, body), columns=["doc_type", "region"]).collect()
    assert [tuple(r) for r in rows] == [("p", "R"), ("q", "R")]
    with pytest.raises(ValueError, match="nowhere"):
        flatten_messages(one(spark, body), columns=["nowhere"])


def test_columns_narrow_the_parsed_schema():
    narrow = layout_schema(narrow_layout(MESSAGE_LAYOUT, {"region"}), FLAT)
    assert narrow.simpleString() == "struct<customer:struct<region:string>,documents:array<struct<type:string>>>"


def test_layout_without_array(spark):
    layout, types = {"a": {"b": "x"}, "c": "y"}, table(x=IntegerType(), y=StringType())
    rows = flatten_messages(one(spark, '{"a":{"b":1},"c":"z"}'), layout, types).collect()
    assert [tuple(r) for r in rows] == [(1, "z")]


def test_layout_with_nested_array_element(spark):
    layout = {"id": "id", "in": {"items": [{"kind": "kind", "at": {"n": "n"}}]}}
    types = table(id=LongType(), kind=StringType(), n=IntegerType())
    body = '{"id":1,"in":{"items":[{"kind":"a","at":{"n":1}},{"kind":"b"}]}}'
    rows = flatten_messages(one(spark, body), layout, types).collect()
    assert [tuple(r) for r in rows] == [(1, "a", 1), (1, "b", None)]


def test_layout_with_two_arrays_raises(spark):
    with pytest.raises(ValueError, match="at most one array"):
        flatten_messages(
            one(spark, "{}"), {"a": [{"b": "x"}], "c": [{"d": "y"}]}, table(x=StringType(), y=StringType())
        )


def test_publishing_appends(spark, tmp_path):
    sink = MessageDir(str(tmp_path / "topic"))
    run_publish(spark, sink, 10)
    run_publish(spark, sink, 10)
    assert read_messages(spark, sink).count() == 20
    assert read_messages(spark, sink).distinct().count() == 10


def test_line_breaks_stay_inside_a_body(spark, tmp_path):
    sink = MessageDir(str(tmp_path / "topic"))
    text = 'a\nb\r\nc\rd\u2028e"\\f\tg'
    df = spark.createDataFrame([(text,), (None,)], "t string")
    write_messages(pack_messages(df, {"t": "t"}).unionByName(one(spark, None)), sink)
    back = flatten_messages(read_messages(spark, sink), {"t": "t"}, table(t=StringType()))
    assert sorted(back.collect(), key=str) == sorted([(text,), (None,)], key=str)


def test_topic_options_come_from_the_caller():
    topic = Topic("loans", {"kafka.bootstrap.servers": "host:9092", "kafka.sasl.jaas.config": "secret"})
    assert topic.read_options() == {
        "subscribe": "loans",
        "startingOffsets": "earliest",
        "kafka.bootstrap.servers": "host:9092",
        "kafka.sasl.jaas.config": "secret",
    }
    assert topic.write_options()["topic"] == "loans"
    assert "startingOffsets" not in topic.write_options()
    assert "secret" not in repr(topic)


def test_field_names_with_dots(spark):
    layout = {"a.b": {"c.d": "x"}, "e.f": [{"g.h": "y"}]}
    types = table(x=IntegerType(), y=StringType())
    packed = pack_messages(spark.createDataFrame([(1, "z")], "x int, y string"), layout)
    assert json.loads(packed.first()["value"]) == {"a.b": {"c.d": 1}, "e.f": [{"g.h": "z"}]}
    assert [tuple(r) for r in flatten_messages(packed, layout, types).collect()] == [(1, "z")]


def test_one_message_may_hold_many_documents(spark):
    documents = [{"type": f"t{i}", "status": "s"} for i in range(100_000)]
    body = json.dumps({"application_id": "a", "documents": documents})
    flat = flatten_messages(one(spark, body))
    assert flat.agg(F.count("*"), F.countDistinct("doc_type")).first() == (100_000, 100_000)


def test_body_with_a_line_break_raises_in_a_directory(spark, tmp_path):
    rows = spark.createDataFrame([("{}\n{}",)], "value string")
    with pytest.raises(Exception, match="line break"):
        write_messages(rows, MessageDir(str(tmp_path / "out")))
