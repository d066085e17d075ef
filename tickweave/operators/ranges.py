"""Ordered computations within keys, when one key may hold any share of the rows.

Rows are range-partitioned by key and order and written with their range's number; windows then run within a range and
key, so no task sees more of a key than a range. What a range needs of those before it is one row: a
sum, a last value or a run that goes on. These rows, at most two for each range, are combined by themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize

PART = "__part"


def ranged(rows: DataFrame, *order) -> DataFrame:
    """The rows by ranges, with the range's number. Runs a job, which writes them."""
    return materialize(rows.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()))


def same_range(a: str, b: str, keys: list[str]) -> Column:
    """That rows a and b are of one range and key."""
    out = F.col(f"{a}.{PART}") == F.col(f"{b}.{PART}")
    for k in keys:
        out &= F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def with_carried(parted: DataFrame, carried: DataFrame, keys: list[str], *names: str) -> DataFrame:
    """The rows with what is carried into their range and key (null if nothing is); carried has a row for each range at most."""
    held = carried.select(PART, *keys, *names).alias("c")
    return parted.alias("r").join(F.broadcast(held), same_range("r", "c", keys), "left").select("r.*", *(F.col(f"c.{n}") for n in names))


def first_keys(parted: DataFrame, keys: list[str]) -> DataFrame:
    """The first key of each range: the only one that can go on from the range before."""
    return parted.groupBy(PART).agg(F.min(F.struct(*keys)).alias("__k")).select(PART, *(F.col(f"__k.{k}").alias(k) for k in keys))


def placed(rows: DataFrame, keys: list[str], order: list[str], amount: str | None = None, n: str = "n", before: str = "before") -> DataFrame:
    """With n, the place within its key from 0, and, of an amount, before, the sum over the key's rows before."""
    parted = ranged(rows, *keys, *order)
    w = Window.partitionBy(PART, *keys).orderBy(*order)
    value = F.coalesce(F.col(amount), F.lit(0)).cast("long") if amount else F.lit(0).cast("long")
    heads = first_keys(parted, keys)
    sums = parted.groupBy(PART, *keys).agg(F.count("*").alias("__rows"), F.sum(value).alias("__sum"))
    # sums of the few keys that go over ranges
    going = sums.alias("s").join(F.broadcast(heads.select(*keys).distinct()).alias("h"), _keys_equal("s", "h", keys), "left_semi")
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = going.withColumns({"__base_rows": F.sum("__rows").over(earlier), "__base_sum": F.sum("__sum").over(earlier)})
    out = with_carried(parted, carried.where("__base_rows > 0"), keys, "__base_rows", "__base_sum")
    within = {n: F.coalesce("__base_rows", F.lit(0)) + F.row_number().over(w) - 1}
    if amount:
        within[before] = F.coalesce("__base_sum", F.lit(0)) + F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return out.withColumns(within).drop(PART, "__base_rows", "__base_sum")


def _keys_equal(a: str, b: str, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out &= F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def with_previous(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """With name, the value of the key's row before (null for its first)."""
    parted = ranged(rows, *keys, *order)
    w = Window.partitionBy(PART, *keys).orderBy(*order)
    ends = parted.groupBy(PART).agg(F.max(F.struct(*keys, *order, F.col(value).alias("__v"))).alias("__x")).select(PART, *(F.col(f"__x.{k}").alias(k) for k in keys), F.col("__x.__v").alias("__last"))
    heads = first_keys(parted, keys)
    # one row for each range, so all are ordered together
    steps = heads.alias("h").join(ends.alias("e"), PART).select(PART, *(F.col(f"h.{k}").alias(k) for k in keys), F.struct(*(F.col(f"e.{k}").alias(k) for k in keys)).alias("__end"), "__last")
    over = Window.orderBy(PART)
    carried = steps.withColumns({"__before": F.lag("__end").over(over), "__carried": F.lag("__last").over(over)})
    carried = carried.where(F.col("__before").isNotNull() & _struct_equal("__before", keys))
    out = with_carried(parted, carried, keys, "__carried")
    return out.withColumn(name, F.when(F.row_number().over(w) == 1, F.col("__carried")).otherwise(F.lag(value).over(w))).drop(PART, "__carried")


def _struct_equal(struct: str, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out &= F.col(f"{struct}.{k}").eqNullSafe(F.col(k))
    return out


def runs(rows: DataFrame, keys: list[str], order: str, value: str, breaks) -> DataFrame:
    """start (the run's first value) and length of each maximal run of a key; breaks(value, value before) tells where one ends.

    Each range gives its runs; of those only its first and its last can go on in another range, so the runs at the
    edges, two for each range, are joined where the ranges meet.
    """
    parted = ranged(rows.select(*keys, order, value), *keys, order)
    w = Window.partitionBy(PART, *keys).orderBy(order)
    broken = (F.row_number().over(w) > 1) & F.coalesce(breaks(F.col(value), F.lag(value).over(w)), F.lit(False))
    marked = parted.withColumn("__broken", broken.cast("int")).withColumn("__run", F.sum("__broken").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    made = materialize(marked.groupBy(PART, *keys, "__run").agg(F.min_by(value, order).alias("__first"), F.max_by(value, order).alias("__last"), F.min(order).alias("__from"), F.count("*").alias("length")))
    place = F.struct(*keys, "__from")
    edges = made.groupBy(PART).agg(F.min(place).alias("__lo"), F.max(place).alias("__hi"))
    told = made.join(F.broadcast(edges), PART).withColumn("__edge", (place == F.col("__lo")) | (place == F.col("__hi")))
    inner = told.where("NOT __edge").select(*keys, F.col("__first").alias("start"), "length")
    over = Window.orderBy(PART, *keys, "__from")
    same = F.lag(PART).over(over) != F.col(PART)
    for k in keys:
        same &= F.lag(k).over(over).eqNullSafe(F.col(k))
    goes_on = F.coalesce(same & ~F.coalesce(breaks(F.col("__first"), F.lag("__last").over(over)), F.lit(False)), F.lit(False))
    joined = told.where("__edge").withColumn("__new", (~goes_on).cast("int")).withColumn("__id", F.sum("__new").over(over.rowsBetween(Window.unboundedPreceding, 0)))
    whole = joined.groupBy(*keys, "__id").agg(F.min_by("__first", F.struct(PART, "__from")).alias("start"), F.sum("length").alias("length"))
    return inner.unionByName(whole.drop("__id"))


def with_halo(rows: DataFrame, keys: list[str], length: int, n: str = "n", block: int = 1 << 16) -> DataFrame:
    """Placed rows in blocks (__block) of a key, each with the first length rows of the block behind it (__halo)."""
    size = max(length, block)
    own = F.floor(F.col(n) / size).cast("long")
    before = F.when((F.col(n) % size < length) & (own > 0), own - 1)
    return rows.withColumn("__block", F.explode(F.array_compact(F.array(own, before)))).withColumn("__halo", F.col("__block") != own)
