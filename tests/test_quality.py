import random

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tillsight.functions.risk import rule_risk
from tillsight.operators import quality, scoring
from tillsight.schema import typed_schema

GOOD = dict(
    transaction_id="1", user_id="1", product_id="PID_1", category="Books", sub_category="Fiction",
    price=2.5, quantity=2, total_amount=5.0, payment_method="PayPal", timestamp="t",
    user_device="Mobile", user_city="Austin", user_age=30, user_gender="F", user_income=50000,
    fraud_label=0,
)


def rows(spark, *changes):
    schema = typed_schema()
    return spark.createDataFrame(
        [tuple({**GOOD, **change}[name] for name in schema.names) for change in changes], schema
    )


def test_amounts(spark):
    df = rows(spark, {}, dict(total_amount=5.01), dict(total_amount=None), dict(price=1.111, total_amount=2.22))
    found = quality.amount_mismatches(df).collect()
    assert [row.total_amount for row in found] == [5.01]
    assert quality.amount_mismatches(df, tolerance=0.02).isEmpty()


def test_domains(spark):
    df = rows(
        spark,
        {},
        dict(transaction_id="2", sub_category="Laptops"),
        dict(transaction_id="3", user_city="Paris", payment_method="Cheque"),
        dict(transaction_id="4", user_city=None, category=None),
        dict(transaction_id="5", category="Toys"),
    )
    checks = quality.producer_domains(spark)
    found = {tuple(row) for row in quality.domain_violations(df, checks).collect()}
    assert found == {
        ("2", "category/sub_category", "Books/Laptops"),
        ("3", "payment_method", "Cheque"),
        ("3", "user_city", "Paris"),
        ("5", "category/sub_category", "Toys/Fiction"),
    }
    single = quality.outside_domain(df, ["user_city"], checks[("user_city",)])
    assert [row.transaction_id for row in single.collect()] == ["3"]


def test_repeated_lists_do_not_repeat_violations(spark):
    twice = spark.createDataFrame([("Austin",), ("Austin",)], "user_city string")
    df = rows(spark, {}, dict(transaction_id="2", user_city="Paris"))
    found = quality.domain_violations(df, {("user_city",): twice})
    assert [row.transaction_id for row in found.collect()] == ["2"]


def test_duplicates(spark):
    df = rows(spark, {}, {}, dict(transaction_id="2"), dict(transaction_id=None), dict(transaction_id=None))
    assert [tuple(row) for row in quality.duplicate_ids(df).collect()] == [("1", 2)]


def test_ranges(spark):
    df = rows(
        spark, {}, dict(quantity=6), dict(quantity=0), dict(user_age=17), dict(price=1000.0),
        dict(user_income=None),
    )
    found = {row.field: (row.checked, row.violations) for row in quality.range_violations(df).collect()}
    assert found == {"quantity": (6, 2), "user_age": (6, 1), "user_income": (5, 0), "price": (6, 1)}


def test_quarantine(spark):
    payloads = [
        '{"transaction_id":"1","price":"2.5"}', "junk", '{"price":"x"}', "null", "",
        '{"transaction_id":""}', "{}", "[1]", '{"transaction_id":"2"', '{"transaction_id":"3","extra":1}',
    ]
    envelope = spark.createDataFrame([(p,) for p in payloads], "t string").select(
        F.col("t").cast("binary").alias("value")
    )
    good, bad = quality.split_quarantine(envelope)
    assert sorted(row.transaction_id for row in good.collect()) == ["1", "3"]
    reasons = {bytes(row.value).decode(): row.reason for row in bad.collect()}
    assert reasons == {
        "junk": "unreadable", "null": "unreadable", "": "unreadable", "[1]": "unreadable",
        '{"transaction_id":"2"': "unreadable", '{"price":"x"}': "missing_id",
        '{"transaction_id":""}': "missing_id", "{}": "missing_id",
    }
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_risk_rules(spark):
    df = rows(
        spark,
        {},
        dict(payment_method="DebitCard"),
        dict(price=500.01, user_age=24, category="Electronics"),
        dict(payment_method="DebitCard", user_income=150001),
        dict(price=None, payment_method=None, user_age=None, user_income=None, category=None),
    )
    assert [row[0] for row in df.select(rule_risk()).collect()] == [10, 5, 30, 0, 5]


def brute_force_area(pairs):
    positives = [score for score, label in pairs if label == 1]
    negatives = [score for score, label in pairs if label == 0]
    wins = sum((p > n) + (p == n) / 2 for p in positives for n in negatives)
    return wins / (len(positives) * len(negatives))


def area(df, **options):
    return scoring.score_auc(df, "score", "label", **options).first()[0]


def test_area_equals_counting_pairs(spark):
    draw = random.Random(5)
    for distinct in (2, 7, 400):
        pairs = [(float(draw.randrange(distinct)), draw.randrange(2)) for _ in range(600)]
        df = spark.createDataFrame(pairs, "score double, label int")
        for ranges in (None, 1, 5, 20):
            assert abs(area(df, ranges=ranges) - brute_force_area(pairs)) < 1e-12


def test_area_when_ranges_are_split_over_files(spark):
    setting = "spark.sql.files.maxRecordsPerFile"
    draw = random.Random(6)
    pairs = [(draw.random(), draw.randrange(2)) for _ in range(600)]
    df = spark.createDataFrame(pairs, "score double, label int")
    spark.conf.set(setting, 17)
    try:
        assert abs(area(df, ranges=3) - brute_force_area(pairs)) < 1e-12
    finally:
        spark.conf.unset(setting)


def test_area_with_a_third_of_rows_on_one_score(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 30000).alias("score"),
        (F.col("id") * 31 % 7 < 3).cast("int").alias("label"),
    )
    mllib = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", numBins=0
    ).evaluate(df)
    assert abs(area(df) - mllib) < 1e-9


def test_area_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (None, 0)], "score double, label int")
    assert area(df) is None
