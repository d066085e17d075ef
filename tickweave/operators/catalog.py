"""Joins and roll-ups over manifests, files and digests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars

MB_PER_HOUR_BUDGET = 700


def completed(attempts: DataFrame) -> DataFrame:
    """Ids that were ever captured well."""
    return attempts.where("status = 'ok'").select("replay_id").distinct()


def attempted(attempts: DataFrame) -> DataFrame:
    return attempts.select("replay_id").distinct()


def to_do(replays: DataFrame, attempts: DataFrame, key: str = "replay_id") -> DataFrame:
    """Replays without a good capture; failed ones are tried again."""
    return replays.join(completed(attempts).withColumnRenamed("replay_id", key), key, "left_anti")


def to_prune(corpus: DataFrame, attempts: DataFrame) -> DataFrame:
    """Corpus files (stem, ...) whose sanitized stem has a good capture; a list, nothing is deleted."""
    done = completed(attempts).select(scalars.stem_of_capture(F.col("replay_id")).alias("safe")).distinct()
    return corpus.withColumn("safe", scalars.sanitized(F.col("stem"))).join(done, "safe", "left_semi").drop("safe")


def orphans(videos: DataFrame, attempts: DataFrame) -> DataFrame:
    """Videos on disk that no manifest lists."""
    return videos.join(attempts.where("video IS NOT NULL").select(F.col("video").alias("path")), "path", "left_anti")


def count_mismatches(left: DataFrame, right: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Keys of left whose counts differ; a missing count differs from any number and from none."""
    return left.join(right, key, "left").where(~F.col(a).eqNullSafe(F.col(b))).select(key, a, b)


def digest_audit(attempts: DataFrame, files: DataFrame) -> DataFrame:
    """state of each artefact of the good captures: ok, missing, mismatch or unverifiable.

    files is (path, sha256) of what is there. An artefact without a recorded digest is unverifiable,
    and its capture isn't counted as verified.
    """
    listed = attempts.where("status = 'ok'").select("replay_id", F.explode(F.array(F.struct(F.lit("video").alias("kind"), F.col("video").alias("path"), F.col("video_sha256").alias("want")), F.struct(F.lit("csv").alias("kind"), F.col("csv").alias("path"), F.col("csv_sha256").alias("want")))).alias("a"))
    listed = listed.select("replay_id", "a.*").where("path IS NOT NULL")
    joined = listed.join(files.select("path", F.col("sha256").alias("got"), F.lit(True).alias("there")), "path", "left")
    want = F.coalesce(F.col("want"), F.lit(""))
    state = F.when(want == "", "unverifiable").when(F.col("there").isNull(), "missing").when(F.col("got").eqNullSafe(F.col("want")), "ok").otherwise("mismatch")
    return joined.select("replay_id", "kind", "path", state.alias("state"))


def audit_tally(audit: DataFrame, attempts: DataFrame) -> DataFrame:
    """checked, verified, unverifiable and problems over the good captures."""
    states = audit.groupBy("replay_id").agg(F.count_if(F.expr("state IN ('missing', 'mismatch')")).alias("problems"), F.count_if(F.expr("state = 'unverifiable'")).alias("unverifiable"))
    good = attempts.where("status = 'ok'").select("replay_id").distinct().join(states, "replay_id", "left").na.fill(0)
    return good.agg(F.count("*").alias("checked"), F.count_if(F.expr("problems = 0 AND unverifiable = 0")).alias("verified"), F.sum("unverifiable").alias("unverifiable"), F.sum("problems").alias("problems"))


def status_rollup(attempts: DataFrame, worker: str, ok: Column, frames: str) -> DataFrame:
    """ok, failed and frames of good captures, for each worker and, with a null worker, for all."""
    out = attempts.rollup(worker).agg(F.count_if(ok).alias("n_ok"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("n_failed"), F.coalesce(F.sum(F.when(ok, F.coalesce(F.col(frames), F.lit(0)))), F.lit(0)).alias("total_frames"))
    return out


def footage(attempts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Hours, video bytes and MB an hour of each worker's good captures, with the budget's verdict; only videos count."""
    joined = attempts.where("status = 'ok'").join(sizes.select(F.col("path").alias("video"), "length"), "video", "left")
    out = joined.rollup("worker").agg(F.sum(F.coalesce("frames", F.lit(0))).alias("total_frames"), F.sum(F.coalesce("length", F.lit(0))).alias("video_bytes"))
    hours = scalars.hours(F.col("total_frames"))
    per_hour = scalars.rate(F.col("video_bytes") / 1e6, hours)
    return out.select("worker", hours.alias("hours"), "video_bytes", per_hour.alias("mb_per_hour"), F.when(hours > 0, F.when(per_hour <= MB_PER_HOUR_BUDGET, "OK").otherwise("OVER")).alias("budget"))


def throughput(captures: DataFrame, host: str, modified: str, frames: str) -> DataFrame:
    """hours and hours a wall-clock hour of each host; the rate is 0 with fewer than two captures."""
    span = (F.unix_timestamp(F.max(modified)) - F.unix_timestamp(F.min(modified))) / 3600
    out = captures.groupBy(host).agg(F.count("*").alias("captures"), scalars.hours(F.sum(frames)).alias("hours"), span.alias("wall_hours"))
    return out.withColumn("rate", F.when(F.col("captures") < 2, F.lit(0.0)).otherwise(scalars.rate(F.col("hours"), F.col("wall_hours"))))


def fleet(hosts: DataFrame, live: str = "live", goal: float = 200.0) -> DataFrame:
    """Total hours of all hosts, the rate of the live ones, and hours until the goal (null if never)."""
    out = hosts.agg(F.sum("hours").alias("hours"), F.coalesce(F.sum(F.when(F.col(live), F.col("rate"))), F.lit(0.0)).alias("rate"))
    return out.withColumn("eta_hours", F.when(F.col("rate") > 0, F.greatest(F.lit(goal) - F.col("hours"), F.lit(0.0)) / F.col("rate")))


def host_audit(attempts: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row: counts, hours, duplicate ids among good captures, sync and mask mismatches, the first five of each."""
    good = attempts.where("status = 'ok'").join(sizes.select(F.col("path").alias("video"), "length"), "video", "left")
    ids = good.groupBy("replay_id").agg((F.count("*") - 1).alias("again"))
    totals = good.agg(F.count("*").alias("ok"), scalars.hours(F.coalesce(F.sum("frames"), F.lit(0))).alias("hours"), (F.coalesce(F.sum("length"), F.lit(0)) / 1e9).alias("gb"))
    failed = attempts.agg(F.count_if(~F.coalesce(F.col("status") == "ok", F.lit(False))).alias("fail"))
    off = ~F.col("validation.csv_rows").eqNullSafe(F.col("validation.video_frames"))

    def firsts(rows: DataFrame, name: str, total: Column) -> DataFrame:
        w = Window.orderBy("replay_id")
        head = rows.orderBy("replay_id").limit(5).select(F.collect_list("replay_id").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(name)).limit(1)
        return rows.agg(total.alias(f"n_{name}")).join(head, how="left")

    dup = firsts(ids.where("again > 0"), "dup", F.coalesce(F.sum("again"), F.lit(0)))
    sync = firsts(good.where(off).select("replay_id"), "sync", F.count("*"))
    mask = firsts(good.where("validation.mask_mismatches > 0").select("replay_id"), "mask", F.count("*"))
    unique = ids.agg(F.count("*").alias("unique_ids"))
    return reduce(lambda a, b: a.join(b), (totals, failed, unique, dup, sync, mask))  # one row each


def by_root(captures: DataFrame) -> DataFrame:
    """Number, frames and bytes of the captures below each root."""
    return captures.groupBy("root").agg(F.count("*").alias("captures"), F.sum("frames").alias("total_frames"), F.sum("bytes").alias("total_bytes"))


def matchups(replays: DataFrame, a: str, b: str, a_name: str, b_name: str) -> DataFrame:
    """How often each pair of characters met."""
    return replays.groupBy(a, b).agg(F.min(a_name).alias("a_name"), F.min(b_name).alias("b_name"), F.count("*").alias("n"))


def outcomes(decoded: DataFrame) -> DataFrame:
    """total, success, failed and skipped of a batch (outcome)."""
    return decoded.agg(F.count("*").alias("total"), *(F.count_if(F.col("outcome") == o).alias(o) for o in ("success", "failed", "skipped")))


def sampled_rate(before: DataFrame, after: DataFrame, seconds: float) -> DataFrame:
    """Frames a second of each worker between two snapshots (worker, done, in_flight), and with a null worker their sum."""
    total = F.coalesce(F.col("done"), F.lit(0)) + F.coalesce(F.col("in_flight"), F.lit(0))
    joined = after.select("worker", total.alias("b")).join(before.select("worker", total.alias("a")), "worker", "left")
    return joined.rollup("worker").agg((F.sum(F.col("b") - F.coalesce("a", F.lit(0))) / seconds).alias("fps"))


def key_sets(**tables: DataFrame) -> DataFrame:
    """Every key of the tables (key) with a 0/1 column for each table that has it."""
    parts = [t.select("key").distinct().select("key", *(F.lit(int(n == name)).alias(n) for n in tables)) for name, t in tables.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("key").agg(*(F.max(n).alias(n) for n in tables))
