"""Writers. None rewrites a file in place: tables are written whole, logs as a new file for each batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bits
from ..schemas import BUTTONS, PLAYERS
from . import files

#: What a folder's name of a value stands for, as Spark's partitioned tables have it.
_ESCAPED = "[\\x00-\\x1F\\x7F\"#%'*/:=?\\\\{\\[\\]^]"


def _folder_name(value: Column) -> Column:
    chars = F.transform(F.split(value, ""), lambda c: F.when(c.rlike(_ESCAPED), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c))
    return F.when(F.coalesce(value, F.lit("")) == "", "__HIVE_DEFAULT_PARTITION__").otherwise(F.when(value.rlike(_ESCAPED), F.array_join(chars, "")).otherwise(value))


def frame_table(frames: DataFrame, order: str = "pos") -> DataFrame:
    """Modern columns: frame dense from 0 in the given order, game_frame, masks and 20 flags; what is missing is 0."""
    dense = F.row_number().over(Window.partitionBy("capture").orderBy(order)) - 1
    masks = {p: F.coalesce(F.col(f"{p}_input"), F.lit(0)) for p in PLAYERS}
    return frames.select("capture", dense.alias("frame"), F.coalesce("tick", F.lit(0)).alias("game_frame"), *(masks[p].alias(f"{p}_input") for p in PLAYERS), *(c for p in PLAYERS for c in bits.buttons(masks[p], p, BUTTONS)))


def write_frames(frames: DataFrame, path: str, order: str = "pos") -> None:
    """CSV with a header, a folder for each capture, rows in frame order; tasks write the captures' files themselves."""
    table = frame_table(frames, order)
    names = table.columns[1:]
    rows = table.repartition("capture").sortWithinPartitions("capture", "frame")
    name = F.concat(F.lit("capture="), _folder_name(F.col("capture").cast("string")), F.lit("/inputs.csv"))
    files.write_lines(rows.select(name.alias("path"), F.concat_ws(",", *names).alias("value")), path, ",".join(names))


def append_manifest(entries: DataFrame, path: str) -> None:
    """Attempts as JSON lines; each call adds files, and files are never changed."""
    entries.write.mode("append").json(path)


append_listing = append_manifest


def append_objects(objects: DataFrame, path: str) -> None:
    """Whole manifest objects (entry, a variant) as JSON lines."""
    objects.select(F.to_json("entry").alias("value")).write.mode("append").text(path)


def write_replays(replays: DataFrame, path: str, buckets: int = 16) -> None:
    """Two Parquet tables, replays and frame_inputs, the latter in folders by a hash of the replay."""
    from ..plans.replay_tables import frame_inputs, replay_dimension

    replay_dimension(replays).write.mode("append").parquet(f"{path}/replays")
    frames = frame_inputs(replays).withColumn("bucket", F.pmod(F.xxhash64("replay_id"), F.lit(buckets)))
    # a folder's rows are together but where they are many: each task writes few files
    frames.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{path}/frame_inputs")


def report_json(reports: DataFrame) -> DataFrame:
    """One JSON text for each capture's report."""
    return reports.select("capture", F.to_json(F.struct(*(c for c in reports.columns))).alias("report"))


def report_text(reports: DataFrame, failing_only: bool = False) -> DataFrame:
    """Each capture's report as lines to read: its verdict, then a line for each finding."""
    lines = F.transform("findings", lambda f: F.concat(F.lit("\n  "), f["severity"], F.lit(" "), f["check"], F.lit(": "), f["detail"]))
    verdict = F.concat(F.when(F.col("ok"), "pass ").otherwise("FAIL "), "capture")
    return (reports.where("NOT ok") if failing_only else reports).select("capture", F.concat(verdict, F.array_join(lines, "")).alias("report"))


def exit_code(reports: DataFrame) -> int:
    """0 if all captures pass, 1 if one fails, 2 without captures."""
    row = reports.agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("bad")).first()
    return 2 if not row["n"] else int(row["bad"] > 0)


def shard_index(members: DataFrame) -> DataFrame:
    """The index of each shard as JSON: its root, rel and frames in order."""
    listed = F.array_sort(F.collect_list(F.struct("n", "root", "rel", "frames")))
    entries = F.transform(listed, lambda x: F.struct(x["root"].alias("root"), x["rel"].alias("rel"), x["frames"].alias("frames")))
    return members.groupBy("shard").agg(F.to_json(entries).alias("index_json"), F.sum("bytes").alias("bytes"))
