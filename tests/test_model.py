import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tillsight.operators import model
from tillsight.plans import jobs
from tillsight.sinks.publish import publish_transactions
from tillsight.sources.topics import FileTopics
from tillsight.sources.warehouse import transactions


@pytest.fixture(scope="module")
def trained(spark, small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("model")
    topics = FileTopics(str(folder / "topics"))
    publish_transactions(transactions(spark, small), topics)
    fitted, area, read, left_out = jobs.training_job(spark, topics, str(folder / "saved"))
    rows = transactions(spark, small)
    assert read == rows.count() and left_out == read - model.complete_rows(rows).count()
    _, test = model.stable_split(model.complete_rows(transactions(spark, small)))
    return fitted, area, str(folder / "saved"), test


def test_saved_model_predicts_the_same(trained):
    fitted, _, path, test = trained
    columns = ["transaction_id", "prediction", "fraud_probability"]
    before = model.score(fitted, test).select(*columns)
    after = model.score(model.load(path), test).select(*columns)
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()


def test_area_is_that_of_the_evaluator(trained):
    fitted, area, _, test = trained
    exact = BinaryClassificationEvaluator(
        labelCol=model.LABEL, metricName="areaUnderROC", numBins=0
    ).evaluate(fitted.transform(test))
    found = area.first()[0]
    assert abs(found - exact) < 1e-9
    assert abs(found - model.evaluator_area(model.score(fitted, test))) < 1e-3
    assert found > 0.55


def test_training_settings(trained):
    regression = trained[0].stages[-1]
    assert regression.getOrDefault("maxIter") == 10
    assert regression.numFeatures == 11


def test_split_does_not_depend_on_partitions(spark, small):
    rows = model.complete_rows(transactions(spark, small))
    training, test = model.stable_split(rows)
    again, _ = model.stable_split(rows.repartition(7).orderBy(F.rand(3)))
    assert training.count() + test.count() == rows.count()
    assert training.exceptAll(again).isEmpty() and again.exceptAll(training).isEmpty()
    assert 0.75 < training.count() / rows.count() < 0.85


def test_split_keeps_its_share_without_ids_and_with_one_hot_id(spark, medium):
    rows = model.complete_rows(transactions(spark, medium))
    for identity in (F.lit(None).cast("string"), F.lit("hot")):
        training, _ = model.stable_split(rows.withColumn("transaction_id", identity))
        assert 0.75 < training.count() / rows.count() < 0.85


def test_random_split_covers_all_rows(spark, small):
    rows = model.complete_rows(transactions(spark, small))
    training, test = model.random_split(rows)
    assert training.count() + test.count() == rows.count()
    assert 0.75 < training.count() / rows.count() < 0.85


def test_incomplete_rows_are_left_out(spark, small):
    rows = transactions(spark, small)
    complete = model.complete_rows(rows)
    missing = rows.filter("category is null or user_age is null").count()
    assert missing > 0 and complete.count() == rows.count() - missing


def test_unseen_value(spark, small):
    rows = model.complete_rows(transactions(spark, small))
    unseen = rows.filter("category = 'PROMO'").withColumn("category", F.lit("Never"))
    kept = model.train(rows, handle_invalid="keep")
    assert model.score(kept, unseen).count() == unseen.count()
    strict = model.train(rows)
    with pytest.raises(Exception, match="Unseen label"):
        model.score(strict, unseen).collect()


def test_index_is_by_frequency_then_text(spark):
    values = ["b", "a", "c", "c", None, "é"]
    rows = spark.createDataFrame([(v,) for v in values], "category string")
    found = {r.category: (r.occurrences, r.category_index) for r in model.frequency_index(rows, "category").collect()}
    assert found == {"c": (2, 0.0), "a": (1, 1.0), "b": (1, 2.0), "é": (1, 3.0)}


def test_job_survives_a_value_that_only_the_test_part_has(spark, small, tmp_path):
    rows = transactions(spark, small)
    _, test = model.stable_split(model.complete_rows(rows))
    rare = test.limit(1).first().transaction_id
    city = F.when(F.col("transaction_id") == rare, "Nowhere").otherwise(F.col("user_city"))
    topics = FileTopics(str(tmp_path / "topics"))
    publish_transactions(rows.withColumn("user_city", city), topics)

    def by_id(rows):  # so that the changed value does not move its row to the other part
        in_test = F.col("transaction_id") == rare
        training, test = model.stable_split(rows)
        return training.filter(~in_test), test.unionByName(training.filter(in_test))

    trained = jobs.training_job(spark, topics, str(tmp_path / "kept"), by_id)
    assert 0.5 < trained.area.first()[0] <= 1
    failing = jobs.training_job
    with pytest.raises(Exception, match="Nowhere|[Uu]nseen"):
        failing(spark, topics, str(tmp_path / "error"), by_id, unseen="error").area.first()


def test_missing_categories_can_be_kept(spark, small):
    rows = transactions(spark, small)
    kept, dropped = model.complete_rows(rows, "keep"), model.complete_rows(rows)
    assert dropped.count() < kept.count() < rows.count()
    with pytest.raises(ValueError):
        model.complete_rows(rows, "guess")


def test_a_save_that_fails_leaves_the_model_before(spark, trained, tmp_path, monkeypatch):
    fitted, _, _, test = trained
    path = str(tmp_path / "model")
    model.save(fitted, path)
    with monkeypatch.context() as broken:
        broken.setattr(model, "write_mark", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            model.save(fitted, path)
    assert model.load(path).indexes.path.endswith("version-000000001/indexes")
    model.save(fitted, path)
    again = model.load(path)
    assert again.indexes.path.endswith("version-000000003/indexes") and again.unseen == "keep"
    assert model.score(again, test).count() == test.count()


def test_as_many_values_as_rows(spark):
    """Every value once but one; places go on from task to task."""
    names = F.concat(F.lit("value-"), F.lpad(F.col("id").cast("string"), 6, "0"))
    rows = spark.range(20_000, numPartitions=5).select(
        F.when(F.col("id") % 4 == 3, F.lit("hot")).otherwise(names).alias("category"),
        F.when(F.col("id") < 9_000, F.lit("x")).otherwise("y").alias("user_gender"),
    )
    found = model.value_indexes(rows, ["category", "user_gender"])
    expected = ["hot", *[f"value-{i:06d}" for i in range(20_000) if i % 4 != 3]]
    by_index = found.filter("column = 'category'").orderBy("index").collect()
    assert [row.value for row in by_index] == expected
    assert [row["index"] for row in by_index] == list(map(float, range(len(expected))))
    gender = {(row.value, row.occurrences, row["index"]) for row in found.filter("column = 'user_gender'").collect()}
    assert gender == {("y", 11_000, 0.0), ("x", 9_000, 1.0)}
    assert model.value_indexes(rows.limit(0), ["category"]).collect() == []


def test_unseen_values_are_kept_skipped_or_refused(spark):
    rows = spark.createDataFrame(
        [("a", "b")] * 2 + [("c", None)], "category string, sub_category string"
    ).withColumns({name: F.lit("z") for name in model.CATEGORICAL_FEATURES[2:]})
    indexes = model.Indexes.fit(rows)
    other = rows.withColumn("category", F.lit("new"))
    kept = indexes.add(other, "keep").select("category_index", "sub_category_index").distinct().collect()
    assert sorted(map(tuple, kept)) == [(2.0, 0.0), (2.0, 1.0)]
    assert indexes.add(other, "skip").count() == 0
    with pytest.raises(Exception, match="Unseen label in category: new"):
        indexes.add(other).collect()
    with pytest.raises(ValueError):
        indexes.add(other, "guess")
