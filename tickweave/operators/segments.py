"""Runs, windows and samples along ordered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ranges
from .numbering import numbered


def contiguous_runs(rows: DataFrame, value: str, keys: list[str] | None = None, order: str | None = None) -> DataFrame:
    """start and length of each maximal run in which every value is one more than the value before.

    In the given order (the value's own without one), by keys. Without keys or order, values are distinct.
    No task sees all rows, of one key neither.
    """
    keys = keys or []
    if not keys and order is None:
        # A value starts a run if its predecessor is missing, and ends one if its successor is: with distinct
        # values, the i-th start belongs to the i-th end.
        v = rows.select(F.col(value).alias("v")).distinct()
        starts = v.join(v.select((F.col("v") + 1).alias("v")), "v", "left_anti")
        ends = v.join(v.select((F.col("v") - 1).alias("v")), "v", "left_anti")
        paired = numbered(starts.select(F.col("v").alias("start")), "start").join(numbered(ends.select(F.col("v").alias("end")), "end"), "rn")
        return paired.select("start", (F.col("end") - F.col("start") + 1).alias("length"))
    return ranges.runs(rows, keys, order or value, value, lambda v, last: v != last + 1)


def longest_run(runs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The longest run, of equally long ones the first."""
    best = F.max(F.struct("length", (-F.col("start")).alias("back"))).alias("x")
    out = runs.groupBy(*(keys or [])).agg(best)
    return out.select(*(keys or []), (-F.col("x.back")).alias("start"), F.col("x.length").alias("length")).where("length IS NOT NULL")


def ordered_runs(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("length"), "start")


def longest_identical(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """n_rows and longest, the most rows in succession with the same value (nulls are the same)."""
    runs = ranges.runs(rows, [key], order, value, lambda v, last: ~v.eqNullSafe(last))
    return runs.groupBy(key).agg(F.sum("length").alias("n_rows"), F.max("length").alias("longest"))


def busiest_window(rows: DataFrame, key: str, order: str, amount: str, length: int, inclusive: bool = False) -> DataFrame:
    """start (from 0) and total of the window of length rows with the largest sum; of equal ones the first.

    Sums are differences of running totals, so long windows cost no more than short ones, and a key's rows are
    dealt out in blocks, each with the rows behind it that its windows reach. The last possible
    start is tried only if inclusive; with no more rows than length, start is 0.
    """
    rows = ranges.placed(rows.select(key, order, F.col(amount).alias("amount")), [key], [order], "amount")
    dealt = ranges.with_halo(rows, [key], length)
    w = Window.partitionBy(key, "__block").orderBy("n")
    value = F.coalesce("amount", F.lit(0))
    end = F.lead(F.col("before") + value, length - 1).over(w)
    tried = F.lead("n", length - (1 if inclusive else 0)).over(w).isNotNull() | (F.col("n") == 0)
    out = dealt.withColumns({"value": value, "total": end - F.col("before"), "tried": tried}).where("NOT __halo")
    best = F.max(F.when(F.col("tried") & F.col("total").isNotNull(), F.struct("total", (-F.col("n")).alias("back"))))
    found = out.groupBy(key).agg(best.alias("x"), F.sum("value").alias("all"))
    return found.select(key, F.coalesce(-F.col("x.back"), F.lit(0)).cast("long").alias("start"), F.coalesce("x.total", "all").alias("total"))


def positional_samples(rows: DataFrame, key: str, order: str, percents: tuple[int, ...] = (15, 40, 65, 90)) -> DataFrame:
    """The rows at n * percent // 100, with percent and i."""
    numbered = rows.withColumns({"i": F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1, "n": F.count("*").over(Window.partitionBy(key))})
    wanted = F.array(*(F.struct(F.lit(p).alias("percent"), F.floor(F.col("n") * p / 100).alias("at")) for p in percents))
    return numbered.withColumn("hit", F.explode(F.filter(wanted, lambda x: x["at"] == F.col("i")))).withColumn("percent", F.col("hit.percent")).drop("hit", "n")
