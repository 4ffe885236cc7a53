"""Places in an order over all rows, without putting them all into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.workspace import cut_lineage

_ROW_BITS = 33


def ranked(rows: DataFrame, group: str, *order) -> DataFrame:
    """``rows`` with ``place``, the number of rows before each in its ``group`` by ``order``.

    One range exchange puts all rows in order by group and then ``order``; a
    row's number in its task plus the rows in earlier tasks is its place. The
    ordered rows are stored, as their numbers hold for that exchange only. What
    is joined to them has a row per task and group.
    """
    in_order = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(group, *order)
    numbered = cut_lineage(in_order.withColumn("_number", F.monotonically_increasing_id()), "ranked").withColumn(
        "_task", F.shiftright("_number", _ROW_BITS)
    )
    tasks = numbered.groupBy(group, "_task").agg(F.min("_number").alias("_first"), F.count("*").alias("_rows"))
    # A group's tasks in order, an entry each, with the rows before them added up along the way.
    in_order = tasks.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_task", "_first", "_rows"))).alias("_tasks"))
    none = F.array().cast("array<struct<_in:bigint,_first:bigint,_before:bigint>>")

    def add(sofar, task):
        entry = F.struct(task["_task"].alias("_in"), task["_first"].alias("_first"), sofar["rows"].alias("_before"))
        return F.struct(
            (sofar["rows"] + task["_rows"]).alias("rows"), F.concat(sofar["starts"], F.array(entry)).alias("starts")
        )

    nothing = F.struct(F.lit(0).cast("bigint").alias("rows"), none.alias("starts"))
    added = F.aggregate("_tasks", nothing, add, lambda sofar: sofar["starts"])
    starts = in_order.select(F.col(group).alias("_of"), F.inline(added))
    same = F.col(group).eqNullSafe(F.col("_of")) & (F.col("_task") == F.col("_in"))
    place = F.col("_number") - F.col("_first") + F.col("_before")
    # At most one row per partition of the exchange and group.
    return numbered.join(F.broadcast(starts), same).select(*rows.columns, place.alias("place"))
