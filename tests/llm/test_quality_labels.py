"""The quality rules learn from every labelled document."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.llm import quality


def test_every_label_counts(spark):
    labels = spark.range(30_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    assert quality.labelled(labels.unionAll(labels)).count() == 30_000


@pytest.mark.parametrize("digits", [1, 3, 12])
def test_threshold_over_ranges_is_that_of_all_rows(spark, digits):
    random.seed(digits)
    rows = [(round(random.gauss(0.3 if good else 0, 0.5), digits), good) for good in random.choices([True, False], k=3000)]
    judged = spark.createDataFrame(rows, "score double, good boolean")
    scores, good = np.array([score for score, _ in rows]), np.array([good for _, good in rows])
    assert quality.threshold_of(judged) == quality.best_threshold(scores, good)
    assert quality.threshold_of(judged.filter("good")) == float("-inf")
    assert quality.threshold_of(judged.limit(0)) == float("-inf")
