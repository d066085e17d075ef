"""Capture files as DataFrames: frame tables, manifests, listings, logs, status files and file sizes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..schemas import BUTTONS, LISTING, MANIFEST, PLAYERS, STATUS, TICK_COLUMNS


@contextmanager
def many_folders(spark: SparkSession) -> Iterator[None]:
    """For reads that are set up inside: folders are listed by as many tasks as a shuffle has, not by one for each of up to 10,000. The session's own setting comes back after."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def frame_files(spark: SparkSession, root: str) -> DataFrame:
    """capture, path and value, the whole text, of root/inputs.csv or else of each root/*/inputs.csv."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    own = jvm.org.apache.hadoop.fs.Path(f"{root}/inputs.csv")
    path = f"{root}/inputs.csv" if own.getFileSystem(conf).exists(own) else f"{root}/*/inputs.csv"
    with many_folders(spark):
        files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select(F.element_at(F.split("path", "/"), -2).alias("capture"), "path", "value")


def frames(files: DataFrame) -> DataFrame:
    """A row for each data line of the (capture, value) texts, and one with a null pos for a text without any.

    frame_column is the header's engine tick column, null if it has none. tick and frame are null where
    they can't be read; failed is where reading a row would stop: tick, frame, p1, p2 or null. p1_input and
    p2_input are the masks (0 if left out), p1_bools and p2_bools those that the separate columns give
    (null unless all of p1's are there; those of p2 that are missing count as off). Lines are told apart by the header alone, so every generation of columns
    can be read.
    """
    lines = F.split(F.regexp_replace("value", "^﻿", ""), "\r?\n")
    split = files.select("capture", lines.alias("lines")).select("capture", F.split(F.element_at("lines", 1), ",").alias("header"), F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0))).alias("lines"))
    rows = split.select("capture", "header", F.posexplode_outer(F.filter("lines", lambda x: x != "")).alias("pos", "line"))
    rows = rows.select("capture", "header", "pos", F.split("line", ",").alias("cells"))

    def cell(name: str) -> Column:
        at = F.array_position("header", name)
        return F.when(at > 0, F.get("cells", (at - 1).cast("int")))

    def has(name: str) -> Column:
        return F.array_contains("header", name)

    column = F.coalesce(*(F.when(has(c), F.lit(c)) for c in TICK_COLUMNS))
    tick = F.coalesce(*(F.when(column == c, cell(c)) for c in TICK_COLUMNS)).try_cast("long")
    with_bools = F.forall(F.array(*(F.lit(f"p1_{b}") for b in BUTTONS)), lambda n: F.array_contains("header", n))
    out = rows.select(
        "capture", "pos", ((F.size("header") > 0) & (F.element_at("header", 1) != "")).alias("has_header"),
        column.alias("frame_column"), has("frame").alias("has_frame"), tick.alias("tick"), cell("frame").try_cast("long").alias("frame_value"),
        *(scalars.number_or_zero(cell(f"{p}_input")).alias(f"{p}_input") for p in PLAYERS),
        *(F.when(with_bools, F.array(*(scalars.number_or_zero(cell(f"{p}_{b}")) for b in BUTTONS))).alias(f"{p}_flags") for p in PLAYERS),
        cell("frame_file").alias("frame_file"),
    )
    bad_flags = {p: F.coalesce(F.exists(f"{p}_flags", lambda x: x.isNull()), F.lit(False)) for p in PLAYERS}
    failed = F.when(F.col("pos").isNull(), None).when(F.col("tick").isNull(), "tick").when(F.col("has_frame") & F.col("frame_value").isNull(), "frame")
    for p in PLAYERS:
        failed = failed.when(F.col(f"{p}_input").isNull() | bad_flags[p], p)
    bools = {p: F.aggregate(F.transform(f"{p}_flags", lambda x, i: F.when(x != 0, F.expr("1L")).otherwise(F.expr("0L")) * F.pow(F.lit(2), i).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b) for p in PLAYERS}
    return out.select("capture", "pos", "has_header", "frame_column", "has_frame", "tick", F.when(F.col("has_frame"), F.col("frame_value")).alias("frame"), failed.alias("failed"), "p1_input", "p2_input", *(bools[p].alias(f"{p}_bools") for p in PLAYERS), "frame_file")


def json_lines(spark: SparkSession, path: str | list[str], schema, pattern: str | None = None) -> DataFrame:
    """Objects of JSON lines with source_file; lines that can't be read, torn ones too, are left out."""
    reader = spark.read.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    full = f"{schema}, _corrupt string" if isinstance(schema, str) else type(schema)([*schema.fields]).add("_corrupt", "string")
    rows = reader.schema(full).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.select("*", F.col("_metadata.file_path").alias("source_file")).where("_corrupt IS NULL").drop("_corrupt")


def manifests(spark: SparkSession, roots: str | list[str], pattern: str = "manifest.jsonl") -> DataFrame:
    """Attempts of every manifest file below the roots, with their worker, the folder's name, and file."""
    rows = json_lines(spark, roots, MANIFEST, pattern)
    return rows.withColumn("worker", F.element_at(F.split("source_file", "/"), -2))


def manifest_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Attempts of whole manifest files with line_no, their order in the file."""
    texts = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))
    parsed = texts.withColumn("e", F.from_json("line", MANIFEST, {"mode": "PERMISSIVE"}))
    return parsed.where(F.col("e").isNotNull() & (F.trim("line") != "") & F.col("e.status").isNotNull()).select("source_file", "line_no", "e.*")


def manifest_objects(spark: SparkSession, roots: str | list[str], pattern: str = "manifest.jsonl") -> DataFrame:
    """source_file and entry, the whole object of each line as a variant: fields that no schema names stay; torn lines go."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(roots)
    entries = lines.select(F.col("_metadata.file_path").alias("source_file"), F.try_parse_json("value").alias("entry"))
    return entries.where(F.col("entry").isNotNull() & F.schema_of_variant("entry").startswith("OBJECT"))


def known_fields(objects: DataFrame, *names: str) -> DataFrame:
    """The objects with the named manifest fields as columns, null where an entry has none or one of another kind."""
    kinds = {f.name: f.dataType.simpleString() for f in MANIFEST.fields}
    return objects.select("*", *(F.try_variant_get("entry", f"$.{n}", kinds[n]).alias(n) for n in names))


def listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Listed replays of an index of JSON lines, those with an id."""
    return json_lines(spark, path, LISTING).where("id IS NOT NULL")


def listing_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Replays of saved listing pages, JSON objects with a list replays; page orders pages by file name."""
    pages = spark.read.schema(f"replays array<struct<{LISTING.replace(' ', ':').replace(',:', ',')}>>, _corrupt string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return pages.select(F.col("_metadata.file_path").alias("page"), F.posexplode("replays").alias("n", "r")).select("page", "n", "r.*")


def replay_files(spark: SparkSession, root: str) -> DataFrame:
    """path, modified, length and content of all replay files below root; Spark's scans leave out files of no bytes."""
    with many_folders(spark):
        rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[rR][eE][pP]").load(root)
    return rows.select("path", F.col("modificationTime").alias("modified"), "length", "content")


def file_sizes(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, length and modified of files below root; contents are not read."""
    with many_folders(spark):
        rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return rows.select("path", "length", F.col("modificationTime").alias("modified"))


def worker_logs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """source_file and in_flight, the last frame count that a log tells of since its last start (null: none)."""
    with many_folders(spark):
        texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), "value")
    since = F.element_at(F.split("value", "Session::init"), -1)
    counts = F.regexp_extract_all(since, F.lit(r"encoder wrote (\d+)"), 1)
    return texts.select("source_file", F.try_element_at(counts, F.lit(-1)).cast("long").alias("in_flight"))


def run_status(runs: DataFrame) -> DataFrame:
    """Status, frames and reason of runs (status_text, exit_reason, exit_code).

    Without a text a run that timed out is timeout and another is failed; a text that can't be read is failed.
    """
    s = F.from_json("status_text", STATUS)
    missing, unread = F.col("status_text").isNull(), s.isNull() | (F.to_json(s) == "{}") & (F.regexp_replace("status_text", r"\s", "") != "{}")
    timed_out = F.coalesce(F.col("exit_reason") == "timeout", F.lit(False))
    return runs.withColumns(
        {
            "status": F.when(missing, F.when(timed_out, "timeout").otherwise("failed")).when(unread, "failed").otherwise(F.coalesce(s["status"], F.lit("failed"))),
            "frames": F.when(missing | unread, F.lit(0)).otherwise(F.coalesce(s["frames"], F.lit(0))),
            "reason": F.when(missing & timed_out, "game timed out before writing status").when(missing, F.concat(F.lit("no status.json (game exited rc="), F.col("exit_code").cast("string"), F.lit(")"))).when(unread, "unreadable status.json").otherwise(s["reason"]),
        }
    )


def upload_state(spark: SparkSession, path: str) -> DataFrame:
    """root and rel of shipped captures: a line root::rel each; paths may hold spaces."""
    lines = spark.read.text(path).where(F.col("value").contains("::"))
    return lines.select(F.substring_index("value", "::", 1).alias("root"), F.expr("substring(value, instr(value, '::') + 2)").alias("rel"))


def legacy_frames(rows: DataFrame) -> DataFrame:
    """Rows of the image era that name their image, with number, the first number in that name."""
    kept = rows.where(F.coalesce(F.col("frame_file"), F.lit("")) != "")
    return kept.withColumn("number", scalars.first_number(F.col("frame_file")))
