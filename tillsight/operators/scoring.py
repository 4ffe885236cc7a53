"""How well a score tells fraud from the rest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.risk import RiskRules, rule_risk
from tillsight.operators.insights import fraud_by


def with_risk(transactions: DataFrame, rules: RiskRules = RiskRules()) -> DataFrame:
    return transactions.withColumn("risk", rule_risk(rules))


def risk_calibration(transactions: DataFrame, rules: RiskRules = RiskRules()) -> DataFrame:
    """Observed fraud per risk level."""
    return fraud_by(with_risk(transactions, rules), "risk")


def score_auc(rows: DataFrame, score: str, label: str, ranges: int | None = None) -> DataFrame:
    """Area under the ROC curve, exact, as one row.

    Counts pairs of a positive and a negative in which the positive scores
    higher, ties as half. Distinct scores may be as many as rows, so they are
    not ranked in one task: a range exchange deals them to as many tasks as
    shuffles have partitions (or ``ranges``), each task adds its scores up in
    order, and only one total per task is put in order at last. How the ranges
    are cut affects balance, not the result. Rows without a score or label are
    left out; with only one class the area is NULL.
    """
    scored = rows.select(
        F.col(score).cast("double").alias("score"), (F.col(label) == 1).alias("positive")
    ).dropna()
    groups = scored.groupBy("score").agg(
        F.count_if("positive").alias("positives"),
        F.count_if(~F.col("positive")).alias("negatives"),
    )
    number = [] if ranges is None else [ranges]
    in_ranges = groups.repartitionByRange(*number, "score").sortWithinPartitions("score")
    totals = in_ranges.mapInArrow(_range_totals, _TOTALS)
    # One entry per range; a range without scores has none.
    in_order = F.array_sort(F.collect_list(F.struct("lowest", "positives", "negatives", "pairs")))
    nothing = F.struct(F.lit(0.0).alias("pairs"), F.lit(0).cast("bigint").alias("positives"), F.lit(0).cast("bigint").alias("negatives"))

    def add(sofar, part):
        pairs = sofar["pairs"] + part["pairs"] + part["positives"].cast("double") * sofar["negatives"]
        return F.struct(
            pairs.alias("pairs"), (sofar["positives"] + part["positives"]).alias("positives"),
            (sofar["negatives"] + part["negatives"]).alias("negatives"),
        )

    def area(sums):
        return F.try_divide(sums["pairs"], sums["positives"].cast("double") * sums["negatives"])

    return totals.agg(in_order.alias("ranges")).select(F.aggregate("ranges", nothing, add, area).alias("area_under_roc"))


_TOTALS = "lowest double, positives bigint, negatives bigint, pairs double"


def _range_totals(batches):
    """One row for a task's scores, which come in order: its counts, and its pairs within the range."""
    lowest, positives, negatives, pairs = None, 0, 0, 0.0
    for batch in batches:
        if not batch.num_rows:
            continue
        up, down = (batch[name].to_numpy() for name in ("positives", "negatives"))
        below = negatives + np.cumsum(down) - down
        pairs += float((up * (below + down / 2)).sum())
        lowest = batch["score"][0].as_py() if lowest is None else lowest
        positives, negatives = positives + int(up.sum()), negatives + int(down.sum())
    if lowest is not None:
        yield pa.RecordBatch.from_pydict(
            {"lowest": [lowest], "positives": [positives], "negatives": [negatives], "pairs": [pairs]}
        )
