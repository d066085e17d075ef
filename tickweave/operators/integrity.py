"""Integrity of captures: statistics and findings for every capture in one pass over all frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bits
from ..schemas import ALL_MASK, PLAYERS, TICK_COLUMNS
from . import ranges

MIN_USABLE_FRAMES = 600
#: Duplicate rows in 10,000 above which a capture fails.
MAX_DUPLICATES = 100


def tick_summary(rows: DataFrame, key: str, order: str, tick: str) -> DataFrame:
    """csv_rows, distinct_frames, duplicate_rows and decreases of each key; no task sees all rows of one."""
    out = ranges.with_previous(rows.select(key, order, tick), [key], [order], tick, "__before").where(F.col(tick).isNotNull())
    fell = F.count_if(F.coalesce(F.col(tick) < F.col("__before"), F.lit(False)))
    out = _with_distinct(out, key, tick, "distinct_frames", csv_rows=(F.count("*"), F.sum), decreases=(fell, F.sum))
    return out.withColumn("duplicate_rows", F.col("csv_rows") - F.col("distinct_frames")).select(key, "csv_rows", "distinct_frames", "decreases", "duplicate_rows")


def _with_distinct(rows: DataFrame, key: str, value: str, name: str, **totals) -> DataFrame:
    """name, the exact number of distinct values of each key, and totals (how to aggregate rows, and these once more).

    Values are integers that lie close together, as ticks and masks do: each 32,768 of them in a row are a bitmap of
    4 KB, and only bitmaps of tasks are shuffled and merged, not values.
    """
    v = F.col(value).cast("long")
    maps = rows.select("*", F.bitmap_bucket_number(v).alias("__bucket"), F.bitmap_bit_position(v).alias("__bit"))
    parts = maps.groupBy(key, "__bucket").agg(F.bitmap_count(F.bitmap_construct_agg("__bit")).alias("__n"), *(how.alias(n) for n, (how, _) in totals.items()))
    return parts.groupBy(key).agg(F.sum(F.when(F.col("__bucket").isNotNull(), F.col("__n")).otherwise(0)).alias(name), *(again(n).alias(n) for n, (_, again) in totals.items()))


def worst_duplicate(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The most frequent value of each key and its count; of equally frequent ones that met first."""
    return _repeats(rows, key, order, value).drop("distinct_frames")


def _repeats(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """worst_value, worst_count and distinct_frames of each key that has values."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = counts.groupBy(key).agg(F.max(F.struct("n", (-F.col("first")).alias("back"), F.col(value).alias("value"))).alias("x"), F.count("*").alias("distinct_frames"))
    return best.select(key, F.col("x.value").alias("worst_value"), F.col("x.n").alias("worst_count"), "distinct_frames")


def dense_counter(rows: DataFrame, key: str, order: str, counter: str) -> DataFrame:
    """Rows, whether the counter is 0, 1, 2, ... in order, and the first place and value that isn't."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    checked = rows.select(key, place.cast("long").alias("place"), F.col(counter).alias("value"))
    wrong = ~F.col("place").eqNullSafe(F.col("value"))
    out = checked.groupBy(key).agg(F.count("*").alias("n_rows"), F.min(F.when(wrong, F.struct("place", "value"))).alias("x"))
    return out.select(key, "n_rows", F.col("x").isNull().alias("dense"), F.col("x.place").alias("first_mismatch"), F.col("x.value").alias("mismatch_value"))


def _finding(check: str, severity: str | Column, detail: Column, when: Column) -> Column:
    level = F.lit(severity) if isinstance(severity, str) else severity
    return F.when(when, F.struct(F.lit(check).alias("check"), level.alias("severity"), detail.alias("detail")))


def _text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("n/a")) for p in parts))


def reports(frames: DataFrame, videos: DataFrame | None = None, require_video: bool = True, expected: DataFrame | None = None) -> DataFrame:
    """A report for each capture: findings (check, severity, detail), ok, and the statistics.

    frames is sources.captures.frames; videos (capture, bytes, video_frames), with null video_frames where
    the video couldn't be read, is left out if videos aren't checked; expected (capture) adds captures
    whose frame table is missing. A row with a good tick and a bad mask counts as a row and as a bad one.
    """
    ticked, framed = F.col("tick").isNotNull(), F.col("tick").isNotNull() & F.col("frame").isNotNull() & F.col("has_frame")
    by_capture = Window.partitionBy("capture").orderBy("pos")  # the one shuffle that windows and aggregate share
    rows = frames.withColumn("n", F.when(ticked, F.sum(ticked.cast("int")).over(by_capture)))
    before = F.last(F.when(ticked, F.col("tick")), ignorenulls=True).over(by_capture.rowsBetween(Window.unboundedPreceding, -1))
    place = F.sum(framed.cast("int")).over(by_capture) - 1
    # p1 is checked in full before p2 is read
    reached = {"p1": ticked & ~F.coalesce(F.col("failed").isin("tick", "frame"), F.lit(False)), "p2": ticked & ~F.coalesce(F.col("failed").isin("tick", "frame", "p1"), F.lit(False))}
    seen = {p: reached[p] & F.col(f"{p}_input").isNotNull() for p in PLAYERS}
    wide = {p: seen[p] & bits.out_of_range(F.col(f"{p}_input")) for p in PLAYERS}
    odd = {p: seen[p] & (F.coalesce(F.col("failed"), F.lit("")) != p) & F.coalesce(F.col(f"{p}_bools") != F.col(f"{p}_input"), F.lit(False)) for p in PLAYERS}

    def witness(p: str) -> Column:
        value = F.col(f"{p}_input")
        return F.when(wide[p], _text("row ", F.col("n"), f": {p}_input=", value)).when(odd[p], _text("row ", F.col("n"), f": {p}_input=", value, " but columns say ", F.col(f"{p}_bools")))

    rows = rows.select(
        "capture", "pos", "has_header", "frame_column", "has_frame", "tick", "frame", "n",
        (F.col("pos").isNotNull() & F.col("failed").isNotNull()).alias("bad"), (ticked & (F.col("tick") < before)).alias("fell"),
        F.when(framed, place).alias("place"),
        *(F.coalesce(seen[p] & (F.col(f"{p}_input") != 0), F.lit(False)).alias(f"{p}_any") for p in PLAYERS),
        sum((F.coalesce(wide[p], F.lit(False)).cast("int") for p in PLAYERS), F.lit(0)).alias("wide"), sum((odd[p].cast("int") for p in PLAYERS), F.lit(0)).alias("odd"),
        F.coalesce(witness("p1"), witness("p2")).alias("witness"),
    )
    wrong = F.col("place").isNotNull() & (F.col("place") != F.col("frame"))
    stats = rows.groupBy("capture").agg(
        F.first("has_header").alias("has_header"), F.first("frame_column").alias("frame_column"), F.first("has_frame").alias("has_frame"),
        F.count("tick").alias("csv_rows"), F.count_if("bad").alias("bad_rows"), F.count_if("fell").alias("decreases"),
        F.count("place").alias("counted"), F.min(F.when(wrong, F.struct("place", "frame"))).alias("gap"), F.min_by("tick", F.when(F.col("tick").isNotNull(), F.col("pos"))).alias("first_tick"),
        *(F.bool_or(f"{p}_any").alias(f"{p}_any") for p in PLAYERS), F.sum("wide").alias("mask_range"), F.sum("odd").alias("mask_mismatches"),
        F.min_by("witness", F.when(F.col("witness").isNotNull(), F.col("pos"))).alias("witness"),
    )
    out = stats.join(_repeats(frames, "capture", "pos", "tick"), "capture", "left").withColumn("distinct_frames", F.coalesce("distinct_frames", F.lit(0))).withColumn("duplicate_rows", F.col("csv_rows") - F.col("distinct_frames"))
    if expected is not None:
        out = expected.select("capture").distinct().join(out.withColumn("present", F.lit(True)), "capture", "left")
    else:
        out = out.withColumn("present", F.lit(True))
    if videos is not None:
        out = out.join(videos.select("capture", F.col("bytes").alias("video_bytes"), "video_frames", F.lit(True).alias("has_video")), "capture", "left")
    else:
        out = out.withColumns({"video_bytes": F.lit(None).cast("long"), "video_frames": F.lit(None).cast("long"), "has_video": F.lit(None).cast("boolean")})

    c = F.col
    present = F.coalesce(c("present"), F.lit(False))
    headed = present & c("has_header") & c("frame_column").isNotNull()
    some = headed & (c("csv_rows") > 0)
    dup, n = c("duplicate_rows"), c("csv_rows")
    many = dup * 10_000 > n * MAX_DUPLICATES
    dense_fail = (c("counted") > 0) & (c("gap").isNotNull() | (c("counted") != n))
    has_video = F.coalesce(c("has_video"), F.lit(False))
    findings = [
        _finding("csv.exists", "error", F.lit("missing inputs.csv"), ~present),
        _finding("csv.header", "error", F.when(~c("has_header"), "empty file").otherwise(f"no engine-tick column; expected one of {', '.join(TICK_COLUMNS)}"), present & ~headed),
        _finding("csv.parse", "error", _text(c("bad_rows"), " unparseable row(s)"), headed & (c("bad_rows") > 0)),
        _finding("csv.mask_range", "error", _text(c("mask_range"), f" input value(s) with bits outside 0x{ALL_MASK:03X} (", c("witness"), ")"), headed & (c("mask_range") > 0)),
        _finding("csv.mask_bits", "error", _text(c("mask_mismatches"), " mask(s) that differ from their own columns (", c("witness"), ")"), headed & (c("mask_mismatches") > 0)),
        _finding("csv.rows", "error", F.lit("no data rows"), headed & (n == 0)),
        _finding("csv.monotonic", "error", _text(c("frame_column"), " decreases ", c("decreases"), " time(s)"), some & (c("decreases") > 0)),
        _finding("csv.duplicates", F.when(many, "error").otherwise("warn"), F.when(many, _text(dup, "/", n, " rows repeat an earlier ", c("frame_column"), "; worst is frame ", c("worst_value"), " x", c("worst_count"))).otherwise(_text(dup, "/", n, " duplicate row(s)")), some & (dup > 0)),
        _finding("csv.start", "warn", _text(c("frame_column"), " starts at ", c("first_tick"), ", not 0"), some & (c("first_tick") != 0)),
        _finding("csv.rowcounter", "error", _text("frame is not dense from 0; first mismatch at row ", F.coalesce(c("gap.place"), c("counted")), " (value ", c("gap.frame"), ")"), some & dense_fail),
        _finding("csv.rowcounter", "warn", F.lit("no frame column present"), some & (c("counted") == 0) & (c("frame_column") == "game_frame")),
        _finding("csv.inputs", "error", F.lit("every input is zero"), some & ~c("p1_any") & ~c("p2_any")),
        _finding("csv.inputs", "warn", _text(F.when(c("p1_any"), "p2").otherwise("p1"), " never pressed anything"), some & (c("p1_any") != c("p2_any"))),
        _finding("csv.length", "warn", _text("only ", n, f" frames (<{MIN_USABLE_FRAMES})"), some & (n < MIN_USABLE_FRAMES)),
    ]
    if videos is not None:
        readable = some & has_video & (c("video_bytes") > 0)
        findings += [
            _finding("video.exists", "error" if require_video else "warn", F.lit("missing video"), some & ~has_video),
            _finding("video.size", "error", F.lit("video is 0 bytes"), some & has_video & (c("video_bytes") == 0)),
            _finding("video.decode", "error", F.lit("the video couldn't be decoded"), readable & c("video_frames").isNull()),
            _finding("video.sync", "error", _text(c("video_frames"), " video frames vs ", n, " rows"), readable & (c("video_frames") != n)),
        ]
    listed = F.array_compact(F.array(*findings))
    return out.select(
        "capture", listed.alias("findings"), (~F.exists(listed, lambda x: x["severity"] == "error")).alias("ok"), "frame_column", F.coalesce(n, F.lit(0)).alias("csv_rows"), "bad_rows", "mask_range", "mask_mismatches", "decreases", "distinct_frames", "duplicate_rows",
        F.when(n > 0, dup / n).alias("duplicate_ratio"), F.when(some & has_video & (c("video_bytes") > 0), c("video_frames")).alias("video_frames"),
    )


def corpus_summary(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count("*").alias("captures"), F.count_if("ok").alias("passed"))


def failing(checked: DataFrame) -> DataFrame:
    return checked.where("NOT ok")


def activity(rows: DataFrame, key: str, mask: str) -> DataFrame:
    """Rows, active rows, distinct states and whether a capture of more than 60 rows is all idle."""
    out = _with_distinct(rows, key, mask, "distinct_states", n_rows=(F.count("*"), F.sum), active_rows=(F.count_if(F.col(mask) != 0), F.sum))
    return out.withColumn("all_idle", (F.col("active_rows") == 0) & (F.col("n_rows") > 60))
