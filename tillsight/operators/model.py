"""Fraud classifier: features, split, training, scoring."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.operators.ranking import ranked
from tillsight.operators.scoring import score_auc
from tillsight.sinks.versions import last_version, next_version, write_mark
from tillsight.workspace import fresh_folder, hadoop_path

# Model inputs, in vector order.
NUMERIC_FEATURES = ["price", "quantity", "total_amount", "user_age", "user_income"]
CATEGORICAL_FEATURES = [
    "category", "sub_category", "payment_method", "user_device", "user_city", "user_gender",
]
INDEXED_FEATURES = [f"{name}_index" for name in CATEGORICAL_FEATURES]
LABEL = "fraud_label"
MODEL_INPUTS = ["transaction_id", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES, LABEL]
# Fields whose text form does not depend on how numbers are printed.
SPLIT_FIELDS = ["transaction_id", *CATEGORICAL_FEATURES, "quantity", "user_age", "user_income"]
MAX_ITERATIONS = 10
TRAIN_SHARE = 0.8
SEED = 42


def complete_rows(transactions: DataFrame, missing: str = "drop") -> DataFrame:
    """The model's inputs, rows with any of them missing left out.

    One NULL category would make the whole fit fail. With ``missing="keep"``
    rows without a category stay, for an indexer that keeps them.
    """
    if missing not in ("drop", "keep"):
        raise ValueError(f"missing is drop or keep, not {missing!r}")
    needed = [*NUMERIC_FEATURES, LABEL] + (CATEGORICAL_FEATURES if missing == "drop" else [])
    return transactions.select(*MODEL_INPUTS).dropna(subset=needed)


def value_indexes(rows: DataFrame, columns=CATEGORICAL_FEATURES) -> DataFrame:
    """(column, value, occurrences, index) for every value of ``columns``.

    The most frequent value has index 0, ties go by text. All columns are
    counted in one pass and ranked by ranges, so no task and not the driver
    holds a column's values, however many there are. NULL has no index.
    """
    pairs = rows.select(*columns).unpivot([], list(columns), "column", "value").filter("value is not null")
    counts = pairs.groupBy("column", "value").agg(F.count("*").alias("occurrences"))
    places = ranked(counts, "column", F.desc("occurrences"), F.asc("value"))
    return places.select("column", "value", "occurrences", F.col("place").cast("double").alias("index"))


def frequency_index(rows: DataFrame, column: str) -> DataFrame:
    """(value, occurrences, index): the index the classifier gives each value."""
    found = value_indexes(rows, [column])
    return found.select(F.col("value").alias(column), "occurrences", F.col("index").alias(f"{column}_index"))


class Indexes:
    """The index tables of the categorical columns, stored in a folder for each column."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def fit(cls, rows: DataFrame, path: str | None = None) -> Indexes:
        spark = rows.sparkSession
        path = path or fresh_folder(spark, "indexes")
        value_indexes(rows).write.partitionBy("column").parquet(path)
        return cls(spark, path)

    def of(self, column: str) -> DataFrame:
        """(value, index) of one column, read by itself so that Spark knows its size."""
        schema = "value string, occurrences bigint, index double"
        folder = f"{self.path}/column={column}"
        place, file_system = hadoop_path(self.spark, folder)
        if not file_system.exists(place):  # a column without any value
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def add(self, rows: DataFrame, unseen: str = "error") -> DataFrame:
        """``rows`` with the index of each column's value.

        Index tables are joined; Spark broadcasts those that are small. A value
        without an index, or none, gets the next one with ``keep``, leaves its
        row out with ``skip``, and fails with ``error``.
        """
        if unseen not in ("keep", "skip", "error"):
            raise ValueError(f"unseen is keep, skip or error, not {unseen!r}")
        for column, name in zip(CATEGORICAL_FEATURES, INDEXED_FEATURES):
            known = self.of(column).select(F.col("value").alias("_value"), F.col("index").alias("_index"))
            rows = rows.join(known, F.col(column) == F.col("_value"), "left").drop("_value")
            if unseen == "keep":
                following = known.agg(F.count("*").cast("double")).scalar()
                rows = rows.withColumn(name, F.coalesce("_index", following))
            elif unseen == "skip":
                rows = rows.withColumn(name, F.col("_index")).filter(F.col(name).isNotNull())
            else:
                message = F.concat(F.lit(f"Unseen label in {column}: "), F.coalesce(column, F.lit("NULL")))
                rows = rows.withColumn(name, F.coalesce("_index", F.raise_error(message).cast("double")))
            rows = rows.drop("_index")
        return rows


def assembler(handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(
        inputCols=[*NUMERIC_FEATURES, *INDEXED_FEATURES],
        outputCol="features",
        handleInvalid=handle_invalid,
    )


def features(transactions: DataFrame, handle_invalid: str = "error") -> DataFrame:
    """Transactions with their index columns and feature vector."""
    indexed = Indexes.fit(transactions).add(transactions, handle_invalid)
    return assembler(handle_invalid).transform(indexed)


def split_draw() -> Column:
    """A number below 2^32 from a hash of the record.

    Other than a random draw it does not depend on how rows are partitioned or
    on which attempt of a task sees them. Repeats of a record stay together.
    More than the id is hashed, so that missing ids, or one id on very many
    records, do not all go to one part.
    """
    digits = F.substring(F.md5(F.concat_ws("|", *SPLIT_FIELDS)), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint")


def in_training(share: float = TRAIN_SHARE, draw: Column | None = None) -> Column:
    """Whether a row belongs to the training part; ``draw`` if it is stored with the row."""
    return (split_draw() if draw is None else draw) < int(share * (1 << 32))


def stable_split(rows: DataFrame, share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """(training, test) by ``in_training``, from the column ``_draw`` if there is one."""
    part = in_training(share, F.col("_draw") if "_draw" in rows.columns else None)
    return rows.filter(part), rows.filter(~part)


def random_split(rows: DataFrame, share: float = TRAIN_SHARE, seed: int = SEED):
    """[training, test] by a seeded draw per row; repeats only on equal partitions."""
    return rows.randomSplit([share, 1 - share], seed=seed)


@dataclass(frozen=True)
class FraudModel:
    """Index tables, the fitted stages behind them, and what becomes of unseen values."""

    indexes: Indexes
    pipeline: PipelineModel
    unseen: str = "error"

    @property
    def stages(self) -> list:
        return self.pipeline.stages

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.pipeline.transform(self.indexes.add(rows, self.unseen))


def train(training: DataFrame, handle_invalid: str = "error") -> FraudModel:
    """Logistic regression on the assembled features.

    ``training`` is read once for the indexes and twice for the regression,
    which then keeps its own blocks for the iterations. Give it a stored table
    rather than a feed still to be decoded.
    """
    regression = LogisticRegression(
        featuresCol="features", labelCol=LABEL, maxIter=MAX_ITERATIONS
    )
    indexes = Indexes.fit(training)
    stages = Pipeline(stages=[assembler(handle_invalid), regression])
    return FraudModel(indexes, stages.fit(indexes.add(training, handle_invalid)), handle_invalid)


def score(fitted: FraudModel, rows: DataFrame) -> DataFrame:
    """``rows`` with the model's prediction, fraud probability and raw margin."""
    scored = fitted.transform(rows)
    return scored.withColumns({
        "fraud_probability": vector_to_array("probability")[1],
        "fraud_margin": vector_to_array("rawPrediction")[1],
    })


def checked_scores(fitted: FraudModel, scored: DataFrame) -> DataFrame:
    """``scored`` with whether the saved weights give its probability and prediction.

    The margin is the intercept plus the weights times the features, computed
    by Spark from the vector and not by the model.
    """
    regression = fitted.stages[-1]
    values = vector_to_array("features")
    margin = F.lit(float(regression.intercept))
    for place, weight in enumerate(regression.coefficients.toArray().tolist()):
        margin += F.lit(weight) * values[place]
    expected = 1 / (1 + F.exp(-margin))
    return scored.withColumns({
        "probability_holds": F.abs(F.col("fraud_probability") - expected) < 1e-9,
        "prediction_holds": (F.col("prediction") == 1) == (F.col("fraud_probability") > 0.5),
    })


def area_under_roc(scored: DataFrame) -> DataFrame:
    """The exact area, as one row."""
    return score_auc(scored, "fraud_margin", LABEL)


def evaluator_area(scored: DataFrame, bins: int = 1000) -> float:
    """The area as MLlib's evaluator estimates it from ``bins`` thresholds, or from all for 0."""
    return BinaryClassificationEvaluator(
        labelCol=LABEL, metricName="areaUnderROC", numBins=bins
    ).evaluate(scored)


def save(model: FraudModel, path: str) -> None:
    """A new version of the model at ``path``; one that fails midway leaves the version before."""
    spark = model.indexes.spark
    version = next_version(spark, path)
    model.pipeline.write().save(f"{version}/stages")
    every = [model.indexes.of(name).withColumn("column", F.lit(name)) for name in CATEGORICAL_FEATURES]
    reduce(DataFrame.unionByName, every).write.partitionBy("column").parquet(f"{version}/indexes")
    spark.createDataFrame([(model.unseen,)], "unseen string").coalesce(1).write.parquet(f"{version}/settings")
    write_mark(spark, f"{version}/{_SAVED}")


def load(path: str) -> FraudModel:
    """The last version of the model that was saved whole."""
    spark = SparkSession.active()
    version = last_version(spark, path, _SAVED)
    unseen = spark.read.parquet(f"{version}/settings").first().unseen
    return FraudModel(Indexes(spark, f"{version}/indexes"), PipelineModel.load(f"{version}/stages"), unseen)


_SAVED = "_SAVED"
