"""Laws that hold for any input, on generated rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.codec import apply_types, decode_transactions, encode_rows
from tillsight.operators.insights import INSIGHTS, one_pass, pick
from tillsight.schema import COLUMNS, raw_schema, typed_schema

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
TEXT = st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=12)
RECORDS = st.lists(st.tuples(*[TEXT] * len(COLUMNS)), min_size=1, max_size=30)


def _value(kind):
    if isinstance(kind, T.DoubleType):
        return st.integers(0, 10**6).map(lambda cents: cents / 100)
    if isinstance(kind, T.IntegerType):
        return st.integers(0, 200_000)
    return st.sampled_from(["a", "b", "c", ""])


TYPED = st.lists(
    st.tuples(*[st.none() | _value(field.dataType) for field in typed_schema()]),
    min_size=1,
    max_size=40,
)


@FEW
@given(RECORDS)
def test_any_text_survives_a_topic(spark, records):
    raw = spark.createDataFrame(records, raw_schema())
    messages = encode_rows(raw).select(F.col("value").cast("binary").alias("value"))
    decoded = sorted(decode_transactions(messages).collect(), key=str)
    assert decoded == sorted(apply_types(raw).collect(), key=str)


@FEW
@given(TYPED)
def test_one_pass_equals_separate_tables(spark, records):
    rows = spark.createDataFrame(records, typed_schema())
    combined = one_pass(rows).cache()
    for name, wanted in INSIGHTS.items():
        separate = _comparable(wanted.build(rows))
        assert _comparable(pick(combined, name)) == separate
    combined.unpersist()


def _comparable(df):
    columns = [
        F.round(name, 6).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes
    ]
    return sorted(df.select(*columns).collect(), key=str)
