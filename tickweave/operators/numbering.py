"""Places in a total order, without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize


def numbered(rows: DataFrame, *order) -> DataFrame:
    """With rn, from 0, in the given order.

    Rows are range-partitioned, sorted and written with their partition's number, so that ranges stay as
    they are; a partition's first place is the count of those before it. Only these counts, one for each
    partition, are added up together. Runs a job, which writes the rows, when it is called.
    """
    parted = materialize(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = parted.groupBy("__part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    placed = parted.withColumn("__k", within).join(F.broadcast(sizes.select("__part", before.alias("__base"))), "__part")
    return placed.withColumn("rn", F.col("__base") + F.col("__k")).drop("__part", "__k", "__base")


def with_sum_before(rows: DataFrame, amount: str, name: str, *order) -> DataFrame:
    """With name, the sum of amount over all rows before in the given order (0 for the first).

    Laid out as in numbered: sums of ranges are added up together, rows only within their range.
    """
    parted = materialize(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sums = parted.groupBy("__part").agg(F.sum(amount).alias("__sum"))
    before = F.coalesce(F.sum("__sum").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.coalesce(F.sum(amount).over(Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = parted.withColumn("__within", within).join(F.broadcast(sums.select("__part", before.alias("__base"))), "__part")
    return placed.withColumn(name, F.col("__base") + F.col("__within")).drop("__part", "__within", "__base")
