from pyspark.sql import functions as F

from tillsight.functions.codec import (
    apply_types,
    as_text,
    number_text,
    decode_transactions,
    encode_rows,
)
from tillsight.operators.model import complete_rows
from tillsight.schema import COLUMNS, raw_schema, typed_schema
from tillsight.sources.warehouse import transactions


def envelope(spark, payloads):
    rows = [(payload,) for payload in payloads]
    return spark.createDataFrame(rows, "text string").select(F.col("text").cast("binary").alias("value"))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_malformed_payloads_become_null_rows(spark):
    payloads = [
        '{"transaction_id":"1","price":"2.5"}',
        "junk",
        '{"transaction_id":7,"price":3.25}',
        '{"price":"x"}',
        "null",
        "",
        None,
    ]
    decoded = decode_transactions(envelope(spark, payloads))
    assert decoded.columns == list(COLUMNS)
    assert decoded.schema == typed_schema()
    found = sorted((row.transaction_id or "", row.price or 0.0) for row in decoded.collect())
    assert found == sorted([("1", 2.5), ("", 0.0), ("7", 3.25), ("", 0.0), ("", 0.0), ("", 0.0), ("", 0.0)])


def test_bad_numerals_become_null(spark):
    raw = spark.createDataFrame(
        [("x", "12.5", ""), ("1e3", "7", "99999999999")], "price string, quantity string, user_age string"
    )
    rows = [tuple(row) for row in apply_types(raw).collect()]
    assert rows == [(None, None, None), (1000.0, 7, None)]


def test_encode_then_decode_keeps_rows(spark, small):
    rows = transactions(spark, small)
    messages = encode_rows(as_text(rows)).select(F.col("value").cast("binary").alias("value"))
    decoded = decode_transactions(messages)
    assert decoded.exceptAll(rows).isEmpty() and rows.exceptAll(decoded).isEmpty()


def test_null_fields_are_left_out_unless_asked_for(spark):
    row = spark.createDataFrame([(None, 1)], "category string, n int")
    assert encode_rows(row).first().value == '{"n":1}'
    assert encode_rows(row, ignore_null_fields=False).first().value == '{"category":null,"n":1}'


def test_non_ascii_text_survives(spark):
    row = spark.createDataFrame([("Décor é 東京",)], "category string")
    message = encode_rows(row).select(F.col("value").cast("binary").alias("value"))
    assert decode_transactions(message, ["category"]).first().category == "Décor é 東京"


def test_only_wanted_fields_are_parsed(spark):
    narrow = plan(decode_transactions(envelope(spark, ["{}"]), ["category", "fraud_label"]))
    assert "StructField(category" in narrow and "StructField(user_city" not in narrow


def test_filters_do_not_parse_again(spark):
    filtered = complete_rows(decode_transactions(envelope(spark, ["{}"]).repartition(2)))
    assert plan(filtered).count("from_json") == 1


def test_unknown_field_is_refused():
    import pytest

    with pytest.raises(ValueError):
        raw_schema(["colour"])


def test_numbers_are_written_out(spark):
    values = [
        1e7, 123456789.0, 12345678.9, -2.5e7, 1e15, 9.007199254740993e15, 1e16, 1.5e16, 1e22, 1e300,
        0.001, 0.0001, 0.00012, -0.00025, 0.00001, 1.5e-7, 0.0, -0.0, 1.0, 0.1, 999.99, None,
    ]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    found = [row.text for row in rows.select(number_text("v").alias("text")).collect()]
    assert found == [None if v is None else str(v) for v in values]
    assert as_text(rows).first()[0] == "10000000.0"
