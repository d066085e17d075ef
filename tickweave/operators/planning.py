"""What to capture, ship or show next: shards, work lists, packing, newest captures."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize
from . import ranges
from .numbering import numbered, with_sum_before


def stride_shard(rows: DataFrame, index: int, count: int, *order) -> DataFrame:
    """Every count-th row of the sorted rows from index on, with rn, its place in the whole."""
    if not 0 <= index < count:
        raise ValueError(f"shard {index} of {count}")
    return numbered(rows, *order).where(F.col("rn") % count == index)


def work_list(replays: DataFrame, attempts: DataFrame, index: int, count: int, limit: int | None, key: str = "replay_id") -> DataFrame:
    """Sort, then shard, then leave out what is done, then limit."""
    from .catalog import to_do

    left = to_do(stride_shard(replays, index, count, key), attempts, key)
    return left.orderBy("rn").limit(limit) if limit is not None else left


def within_budget(rows: DataFrame, amount: str, budget: int, *order) -> DataFrame:
    """Rows in order as long as those before them are below the budget; the one that reaches it still counts."""
    return with_sum_before(rows, amount, "__used", *order).where(F.col("__used") < budget).drop("__used")


def keep_first(rows: DataFrame, key: str, *order) -> DataFrame:
    """The first row of each key in an explicit order."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__n = 1").drop("__n")


def unusable_reason(ranked_only: bool = False, min_elo: float = 0.0) -> Column:
    """Why a listed replay isn't worth a capture; null if it is."""
    reason = F.when(F.coalesce("mountainVaporBug", F.lit(False)), "mountainVaporBug")
    if ranked_only:
        reason = reason.when(F.coalesce("unranked", F.lit(False)), "unranked")
    if min_elo:
        low = F.least(F.coalesce("serverUserElo", F.lit(0.0)), F.coalesce("clientUserElo", F.lit(0.0)))
        reason = reason.when(low < min_elo, F.concat(F.lit("elo "), F.format_string("%.0f", low), F.lit(f" < {min_elo:.0f}")))
    return reason


def without_names(listing: DataFrame, keep: bool = False) -> DataFrame:
    return listing if keep else listing.drop("serverUserNick", "clientUserNick")


def new_listings(pages: DataFrame, index: DataFrame, have: DataFrame, count: int, ranked_only: bool = False, min_elo: float = 0.0) -> DataFrame:
    """Listed replays not yet seen, the first of each id in page order, usable ones, up to count in all.

    Counts have when it is called, to know how many are left.
    """
    seen = index.select("id").unionByName(have.select("id")).distinct()
    fresh = keep_first(pages, "id", "page", "n").join(seen, "id", "left_anti").where(unusable_reason(ranked_only, min_elo).isNull())
    left = max(0, count - have.select("id").distinct().count())
    return without_names(fresh.orderBy("page", "n").limit(left))


def with_artefacts(attempts: DataFrame, files: DataFrame) -> DataFrame:
    """Good attempts whose video and frame table are both among the files (path)."""
    good = attempts.where("status = 'ok'")
    for kind in ("video", "csv"):
        good = good.join(files.select(F.col("path").alias(kind)), kind, "left_semi")
    return good


def newest(attempts: DataFrame, n: int, *order) -> DataFrame:
    """The first n attempts in an order that puts new ones first."""
    return attempts.orderBy(*order).limit(n)


def newest_or_by_name(attempts: DataFrame, captures: DataFrame, n: int, *order) -> DataFrame:
    """capture of the n newest attempts or, if there are none at all, of the first n captures by name.

    Looks for attempts when it is called.
    """
    listed = newest(attempts, n, *order).select("capture")
    return captures.select("capture").orderBy("capture").limit(n) if listed.isEmpty() else listed


def next_shard(names: DataFrame, host: str) -> DataFrame:
    """One row, index: one more than the largest of the host's shard names (name), 0 without any."""
    from ..functions.scalars import shard_index

    own = names.where(F.regexp_replace("name", r"-\d+(\.tar)?$", "") == host)
    return own.agg((F.coalesce(F.max(shard_index(F.col("name"))), F.lit(-1)) + 1).alias("index"))


def not_shipped(captures: DataFrame, shipped: DataFrame) -> DataFrame:
    """Captures (root, rel, ...) that aren't in the upload state."""
    return captures.join(shipped.select("root", "rel"), ["root", "rel"], "left_anti")


#: Items of a group that one task walks through.
BLOCK = 100_000


def _exits(group: str, block: int):
    """For items (group, n, next), last first by block, where a bin that starts at one leaves its block."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: object = walk  # no block yet
        known: dict[int, int | None] = {}
        for batch in batches:
            out: list[int | None] = []
            for key, n, after in zip(*(batch.column(c).to_pylist() for c in (group, "n", "next")), strict=True):
                if at != (key, n // block):
                    at = (key, n // block)
                    known = {}
                known[n] = known[after] if after in known else after
                out.append(known[n])
            yield pa.RecordBatch.from_arrays([batch.column(group), batch.column("n"), pa.array(out, pa.int64())], names=[group, "n", "exit"])

    return walk


def _starts(group: str, block: int):
    """For items (group, n, next, enters), first first by block, how many bins have started in the block up to each."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: object = walk
        expected: int | None = None
        count = 0
        for batch in batches:
            counts, firsts = [], []
            for key, n, after, enters in zip(*(batch.column(c).to_pylist() for c in (group, "n", "next", "enters")), strict=True):
                if at != (key, n // block):
                    at, expected, count = (key, n // block), None, 0
                if enters or n == expected:
                    count, expected = count + 1, after
                    firsts.append(1)
                else:
                    firsts.append(0)
                counts.append(count)
            yield pa.RecordBatch.from_arrays([batch.column(group), batch.column("n"), pa.array(counts, pa.int64()), pa.array(firsts, pa.int64())], names=[group, "n", "upto", "starts"])

    return walk


def _next_bins(items: DataFrame, group: str, cap: int) -> DataFrame:
    """(group, n, next) of items (group, n, size, before): the place at which a bin that starts at n is closed.

    That is the first item whose total passes the sum before n by more than cap, or the one behind it if
    nothing but that item has a size. Items and the sums that are looked for are sorted together by range; for the last of a range, the
    first item of the ranges behind is one row.
    """
    goal = F.struct(F.col("n"), F.col("before"))
    asked = items.select(group, (F.col("before") + cap).alias("v"), F.lit(1).alias("kind"), "n", "before", F.lit(None).cast("struct<n:bigint,before:bigint>").alias("item"))
    met = items.select(group, (F.col("before") + F.col("size")).alias("v"), F.lit(0).alias("kind"), "n", "before", goal.alias("item"))
    parted = ranges.ranged(asked.unionByName(met), group, "v", "kind", "n")
    backwards = Window.partitionBy(ranges.PART, group).orderBy(F.desc("v"), F.desc("kind"), F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the first item of each range's first group, for the ranges before that end in this group
    heads = ranges.first_keys(parted, [group])
    firsts = parted.where("kind = 0").alias("r").join(F.broadcast(heads).alias("h"), ranges.same_range("r", "h", [group]), "left_semi").groupBy(ranges.PART, group).agg(F.min("item").alias("item"))
    parts = parted.groupBy(ranges.PART).agg(F.max(F.struct(group)).alias("k")).select(ranges.PART, F.col(f"k.{group}").alias(group))
    behind = Window.partitionBy(group).orderBy(F.desc(ranges.PART)).rowsBetween(Window.unboundedPreceding, -1)
    both = parts.withColumn("ends", F.lit(True)).join(firsts.withColumnRenamed(group, "g").withColumnRenamed(ranges.PART, "p"), (F.col(group).eqNullSafe(F.col("g"))) & (F.col(ranges.PART) == F.col("p")), "full")
    both = both.select(F.coalesce(ranges.PART, "p").alias(ranges.PART), F.when(F.col("ends"), F.col(group)).otherwise(F.col("g")).alias(group), "item")
    carried = both.withColumn("__behind", F.min("item").over(behind)).where("__behind IS NOT NULL").drop("item")
    found = ranges.with_carried(parted.withColumn("found", F.last("item", ignorenulls=True).over(backwards)).where("kind = 1"), carried, [group], "__behind")
    hit = F.coalesce("found", "__behind")
    return found.select(group, "n", F.when(hit["before"] > F.col("before"), hit["n"]).otherwise(hit["n"] + 1).alias("next"))


def next_fit(items: DataFrame, group: str, order: list[str], amount: str, cap: int, block: int = BLOCK) -> DataFrame:
    """Items with n, their place, and bin: a bin closes when the next item would exceed cap; a larger item is alone.

    A bin depends on all items before. Sums by range give each item the start of the next bin, were it the start of one; blocks of
    a fixed number of items are walked through in tasks of their own, which gives where a bin that starts in a block
    leaves it; and pointer doubling over these exits, of which few are different, gives the start that enters each block. No task walks
    more than a block, one group may hold all items, and there are as many rounds as the number of blocks has binary digits.
    """
    fields = [c for c in items.columns if c != group]
    sort = list(dict.fromkeys([*order, *fields]))
    size = F.greatest(F.coalesce(F.col(amount), F.lit(0)), F.lit(0)).cast("long")
    all_ = materialize(ranges.placed(items.select(group, *fields, size.alias("__size")), [group], sort, "__size", "n", "__before"))
    sized = all_.select(group, "n", F.col("__size").alias("size"), F.col("__before").alias("before"))
    after = materialize(_next_bins(sized, group, cap))
    blocked = after.withColumn("__block", F.floor(F.col("n") / block))
    kind = after.schema[group].dataType.simpleString()
    exits = materialize(blocked.repartition(group, "__block").sortWithinPartitions(group, "__block", F.desc("n")).select(group, "n", "next").mapInArrow(_exits(group, block), f"`{group}` {kind}, n long, exit long"))
    entered = exits.where("n = 0").select(group, "n")
    left = exits.where("exit IS NOT NULL").select(group, F.col("exit").alias("n")).distinct()
    equal = lambda a, b, x, y: F.col(f"{a}.{group}").eqNullSafe(F.col(f"{b}.{group}")) & (F.col(f"{a}.{x}") == F.col(f"{b}.{y}"))
    steps = exits.alias("e").join(left.unionByName(entered).distinct().alias("c"), equal("e", "c", "n", "n"), "left_semi").where("exit IS NOT NULL")
    steps = materialize(steps)
    while not steps.isEmpty():
        reached = entered.alias("e").join(steps.alias("s"), equal("e", "s", "n", "n")).select(f"e.{group}", F.col("s.exit").alias("n"))
        entered = materialize(entered.unionByName(reached).distinct())
        steps = materialize(steps.alias("a").join(steps.alias("b"), equal("a", "b", "exit", "n")).select(f"a.{group}", "a.n", "b.exit"))
    marked = blocked.alias("b").join(entered.withColumn("enters", F.lit(True)).alias("e"), equal("b", "e", "n", "n"), "left").select("b.*", F.coalesce("e.enters", F.lit(False)).alias("enters"))
    counted = materialize(marked.repartition(group, "__block").sortWithinPartitions(group, "__block", "n").select(group, "n", "next", "enters").mapInArrow(_starts(group, block), f"`{group}` {kind}, n long, upto long, starts long")).withColumn("__block", F.floor(F.col("n") / block))
    blocks = counted.groupBy(group, "__block").agg(F.sum("starts").alias("starts"))
    earlier = Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    base = blocks.select(group, "__block", F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("__base"))
    bins = counted.alias("c").join(base.alias("k"), equal("c", "k", "__block", "__block")).select(f"c.{group}", "c.n", (F.col("__base") + F.col("upto") - 1).cast("int").alias("bin"))
    return all_.alias("a").join(bins.alias("b"), equal("a", "b", "n", "n")).select(f"a.{group}", "a.n", "b.bin", *(f"a.{f}" for f in fields))


def shard_plan(captures: DataFrame, host: str, order: list[str], amount: str, cap: int, first: int = 0) -> DataFrame:
    """next_fit with each bin's shard name, numbered on from the first free index."""
    from ..functions.scalars import shard_name

    return next_fit(captures, host, order, amount, cap).withColumn("shard", shard_name(F.col(host), F.col("bin") + first))
