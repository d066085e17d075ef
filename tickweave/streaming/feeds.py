"""Streams of attempts, counters, throughput, uploads and listings.

Files that never change come as Spark's file streams; manifests that are appended to in place as a stream of their complete lines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.planning import keep_first
from ..schemas import LISTING, MANIFEST
from ..sources.growing import GrowingLines


def attempt_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Attempts as files arrive, so many files a batch at most; lines that can't be read are left out."""
    schema = type(MANIFEST)([*MANIFEST.fields]).add("_corrupt", "string")
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.where("_corrupt IS NULL").drop("_corrupt")


def appended_attempts(spark: SparkSession, root: str, pattern: str = "manifest.jsonl") -> DataFrame:
    """path, at (the line's first byte) and fields of attempts as workers append them to the manifests below root.

    A line is given once, when its end has been written; lines that can't be read are left out.
    """
    spark.dataSource.register(GrowingLines)
    lines = spark.readStream.format("growing_lines").option("path", root).option("pattern", pattern).load()
    parsed = lines.withColumn("e", F.from_json("value", type(MANIFEST)([*MANIFEST.fields]).add("_corrupt", "string"), {"columnNameOfCorruptRecord": "_corrupt"}))
    return parsed.where("trim(value) <> '' AND e IS NOT NULL AND e._corrupt IS NULL").select("path", "at", *(F.col(f"e.{f.name}") for f in MANIFEST.fields))


class _Totals(StatefulProcessor):
    """Frames of a worker whose counter goes back to 0 with each replay; the state is two numbers."""

    def __init__(self, key: str, counter: str, order: list[str]):
        self.key, self.counter, self.order = key, counter, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("frames", "done long, last long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        made = Row(self.key, *self.order, "done", "in_flight", "total")
        done, last = self.state.get() or (0, 0)
        # nulls last
        for row in sorted(rows, key=lambda r: [(r[c] is None, r[c]) for c in self.order]):
            count = int(row[self.counter])
            if count < last:
                done += last
            last = count
            yield made(row[self.key], *(row[c] for c in self.order), done, count, done + count)
        self.state.update((done, last))

    def close(self) -> None:
        pass


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries that are started inside keep their state in RocksDB, which keyed state needs; the session's own setting comes back after."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def frame_totals(samples: DataFrame, worker: str, counter: str, order: list[str]) -> DataFrame:
    """done (frames of ended replays), in_flight and total of each sample of a worker's counter, which never go back.

    A counter below the one before means that a replay has ended with that one. Samples of a worker come in order from batch to
    batch; within one they are sorted. Null counters are left out. Start it within keyed_state.
    """
    kind = {f.name: f.dataType.simpleString() for f in samples.schema.fields}
    out = ", ".join(f"{c} {kind[c]}" for c in [worker, *order]) + ", done long, in_flight long, total long"
    held = samples.where(F.col(counter).isNotNull()).select(worker, counter, *order)
    return held.groupBy(worker).transformWithState(_Totals(worker, counter, order), out, "Append", "None")


def listing_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Listed replays, the first of each id; the ids seen are the state, which grows with their number."""
    rows = spark.readStream.schema(LISTING).option("maxFilesPerTrigger", max_files).json(path)
    return rows.where("id IS NOT NULL").dropDuplicates(["id"])


def throughput_stream(samples: DataFrame, time: str = "ts", frames: str = "frames", every: str = "5 seconds", late: str = "1 minute") -> DataFrame:
    """Frames of each interval; rows later than late are left out.

    In append mode an interval is given once, when nothing can be added to it, and its state goes.
    """
    w = samples.withWatermark(time, late).groupBy(F.window(time, every)).agg(F.count("*").alias("n"), F.sum(frames).alias("frames"))
    return w.select(F.col("window.start").alias("start"), "n", "frames")


def intake(pages: DataFrame, index: str, checkpoint: str, key: str = "id", order: tuple[str, ...] = ()) -> StreamingQuery:
    """Writes the listed replays that the index doesn't hold to it, the first of each id in the given order.

    What has been seen is the index itself, which each batch is held against, and no state of the stream: state
    doesn't grow with the replays. A batch writes a folder of its own number and looks only at those before, so a batch that runs again replaces what it wrote.
    """
    spark = pages.sparkSession
    spark.createDataFrame([], pages.schema).write.mode("ignore").parquet(f"{index}/batch=-1")

    def batch(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        seen = session.read.schema(rows.schema.add("batch", "long")).parquet(index).where(F.col("batch") < number).select(key)
        fresh = keep_first(rows.where(F.col(key).isNotNull()), key, *(order or rows.columns)).join(seen, key, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{index}/batch={number}")

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ship(captures: DataFrame, state: str, checkpoint: str, upload: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Uploads what has arrived and only then records it, once for each batch number: nothing is lost on a crash.

    captures has root and rel. An upload can happen twice for the same batch number; it must be idempotent by it.
    """

    def batch(rows: DataFrame, number: int) -> None:
        upload(rows, number)
        rows.select(F.concat_ws("::", "root", "rel").alias("value")).write.mode("overwrite").text(f"{state}/batch={number}")

    return captures.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
