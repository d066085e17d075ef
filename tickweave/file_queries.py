"""Capture operators that read files or streams as queries: inputs are first written from the driver's tables.

Each query writes its inputs into a new folder of the shared one and reads them back with the sources.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog_queries import _EVENTS, _dealt, _events, _frame_texts, _t
from .functions import bits, scalars
from .operators import catalog, integrity, planning, replays, segments
from .schemas import BUTTONS
from .sources import captures, files, sinks
from .storage import shared_dir
from .streaming import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql.replace("{EVENTS}", _EVENTS)
        return f

    return add


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tickweave-files-{uuid.uuid4().hex}"


def _write_texts(rows: DataFrame, folder: str, part: str) -> str:
    """One text file with the values of each of few parts, in a folder of its own, part=..."""
    rows.select(part, "value").repartition(part).write.partitionBy(part).text(folder)
    return folder


def _written(rows: DataFrame, folder: str) -> str:
    """Files of (path below the folder, value)."""
    files.write_files(rows.select(F.concat(F.lit(f"{folder}/"), "path").alias("path"), F.col("value").cast("binary").alias("content")))
    return folder


@_query("""SELECT concat('worker=w', o_orderkey % 3) AS worker, CAST(o_orderkey AS VARCHAR) AS replay_id, CASE WHEN o_orderstatus = 'F' THEN 'ok' ELSE 'failed' END AS status, o_orderkey % 1000 AS frames FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL SELECT 'appended', CAST(o_orderkey AS VARCHAR), 'late', CAST(NULL AS BIGINT) FROM orders WHERE o_orderkey % 5 < 2""")
def torn_manifests(spark, sf_dir):
    """Manifests below a root, with torn lines, and two batches that were appended."""
    root = _folder(spark)
    k = F.col("o_orderkey")
    orders = _t(spark, sf_dir, "orders")
    entry = F.to_json(F.struct(k.cast("string").alias("replay_id"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed").alias("status"), (k % 1000).alias("frames")))
    lines = orders.select(F.concat(F.lit("w"), k % 3).alias("worker"), F.when(k % 7 == 0, F.substring(entry, 1, 20)).otherwise(entry).alias("value"))
    _write_texts(lines, f"{root}/corpus", "worker")
    late = orders.select(k.cast("string").alias("replay_id"), F.lit("late").alias("status"), (k % 5).alias("m"))
    for m in (0, 1):
        sinks.append_manifest(late.where(F.col("m") == m).drop("m"), f"{root}/corpus/appended")
    return captures.manifests(spark, f"{root}/corpus", "*.{txt,json}").select("worker", "replay_id", "status", "frames")


@_query("""WITH p AS (SELECT c_custkey % 400 AS id, c_nationkey AS page, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS n, c_custkey FROM customer),
f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY page, n) AS rn FROM p), have AS (SELECT DISTINCT c_custkey % 400 AS id FROM customer WHERE c_custkey % 400 % 19 = 0),
u AS (SELECT * FROM f WHERE rn = 1 AND id % 17 <> 0 AND id % 19 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 11 <> 0 AND least(1000 + c_custkey % 500, 1200) >= 1100)
SELECT id, CAST(1000 + c_custkey % 500 AS DOUBLE) AS elo FROM u ORDER BY page, n LIMIT (SELECT greatest(0, 120 - count(*)) FROM have)""")
def listing_intake(spark, sf_dir):
    """Saved pages of a listing against the index of what has been seen; usable ones, up to 120 with those that are there."""
    root, c = _folder(spark), F.col("c_custkey")
    customers = _t(spark, sf_dir, "customer")
    listed = F.struct(
        c.alias("n"), (c % 400).alias("id"), (c % 11 == 0).alias("unranked"), (c % 13 == 0).alias("mountainVaporBug"),
        (1000 + c % 500).cast("double").alias("serverUserElo"), F.lit(1200.0).alias("clientUserElo"), F.col("c_name").alias("serverUserNick"),
    )
    pages = customers.groupBy(F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("page")).agg(F.to_json(F.struct(F.array_sort(F.collect_list(listed)).alias("replays"))).alias("value"))
    _write_texts(pages, f"{root}/pages", "page")
    ids = customers.select((c % 400).alias("id"))
    sinks.append_listing(ids.where("id % 17 = 0"), f"{root}/index")
    have = ids.where("id % 19 = 0").distinct()
    found = planning.new_listings(captures.listing_pages(spark, f"{root}/pages"), captures.listing(spark, f"{root}/index"), have, 120, ranked_only=True, min_elo=1100)
    return found.select("id", F.col("serverUserElo").alias("elo"))


@_query("""SELECT CAST(s_suppkey AS INTEGER) AS worker, CAST(CASE WHEN s_suppkey % 2 = 1 THEN s_suppkey WHEN s_suppkey % 3 <> 0 THEN s_suppkey * 10 END AS BIGINT) AS in_flight FROM supplier""")
def log_frames(spark, sf_dir):
    """The last frame count after the last start that a worker's log tells of."""
    n = F.col("s_suppkey")
    wrote = lambda c: F.concat(F.lit("encoder wrote "), c, F.lit(" frames"))
    again = F.when(n % 2 == 0, F.concat(F.lit("Session::init\n"), F.when(n % 3 == 0, F.lit("waiting")).otherwise(F.concat(wrote(n * 5), F.lit("\n"), wrote(n * 10))))).otherwise(F.lit("idle"))
    logs = _dealt(spark, sf_dir, "supplier").select(F.concat(F.lit("worker="), n, F.lit("/log.txt")).alias("path"), F.concat_ws("\n", F.lit("Session::init"), wrote(n), again, F.lit("")).alias("value"))
    read = captures.worker_logs(spark, _written(logs, _folder(spark)))
    return read.select(F.regexp_extract("source_file", r"worker=(\d+)", 1).cast("int").alias("worker"), "in_flight")


@_query("SELECT CAST(s_suppkey AS INTEGER) AS part, s_suppkey % 90 * 100 + 1 AS length FROM supplier")
def artefact_sizes(spark, sf_dir):
    """Sizes of files, contents unread."""
    n = F.col("s_suppkey")
    texts = _dealt(spark, sf_dir, "supplier").select(F.concat(F.lit("part="), n, F.lit("/x.txt")).alias("path"), F.expr("repeat('x', cast(s_suppkey % 90 * 100 as int)) || chr(10)").alias("value"))
    sizes = captures.file_sizes(spark, _written(texts, _folder(spark)), "*.txt")
    return sizes.where("modified IS NOT NULL").select(F.regexp_extract("path", r"part=(\d+)", 1).cast("int").alias("part"), "length")


def _broken_replays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for n in map(int, pdf["s_suppkey"]):
            deck = struct.pack("<I3H", 3, 1, 2, 200 + n % 5000)
            # bytes that mean nothing tell files apart
            head = struct.pack("<IIBBIH", 210, n & 0xFFFFFFFF, n % 22, n % 8, n >> 32 & 0xFFFFFFFF, 0) + deck + struct.pack("<BB5x", (n + 1) % 22, 1) + deck + bytes([n % 20, n % 5]) + bytes(10)
            body = {1: b"\xff" * 600, 2: zlib.compress(b""), 3: zlib.compress(bytes(4 * (100 + n % 50)))}.get(n % 5, zlib.compress(struct.pack("<HH", 1, 2) * (1 + n % 50)))
            out.append((f"/corpus/{n}.rep", head[: 10 if n % 5 == 0 else None] if n % 5 == 0 else head.ljust(0x80, b"\xff") + body))
        yield pd.DataFrame(out, columns=["path", "content"])


def _damaged(spark, sf_dir) -> DataFrame:
    return _dealt(spark, sf_dir, "supplier").select("s_suppkey").mapInPandas(_broken_replays, "path string, content binary")


@_query("""SELECT concat('/corpus/', s_suppkey, '.rep') AS file_path, CASE s_suppkey % 5 WHEN 0 THEN 'File too small (10 bytes)' WHEN 1 THEN 'Could not find compressed input data' WHEN 2 THEN 'No frame data in decompressed stream'
WHEN 3 THEN 'Warning: all inputs are zero (possible parse error)' ELSE '' END AS errors, CASE WHEN s_suppkey % 5 > 0 THEN CAST(s_suppkey % 22 AS INTEGER) END AS p1_character_id,
CAST(CASE s_suppkey % 5 WHEN 3 THEN 100 + s_suppkey % 50 WHEN 4 THEN 1 + s_suppkey % 50 END AS BIGINT) AS total_frames FROM supplier""")
def decode_errors(spark, sf_dir):
    """What broken replay files still give, with the errors met."""
    out = replays.decode(_damaged(spark, sf_dir))
    return out.select("file_path", F.array_join("parse_errors", "; ").alias("errors"), "p1_character_id", "total_frames")


@_query("""SELECT count(*) AS total, count(*) FILTER (WHERE s_suppkey % 5 > 3) - count(*) FILTER (WHERE s_suppkey % 5 = 4 AND s_suppkey < 10) + count(*) FILTER (WHERE s_suppkey % 5 = 3) AS success,
count(*) FILTER (WHERE s_suppkey % 5 < 3) AS failed, count(*) FILTER (WHERE s_suppkey % 5 = 4 AND s_suppkey < 10) AS skipped FROM supplier""")
def ingest_outcomes(spark, sf_dir):
    """Outcomes of a batch of replay files of which some are known by their hash."""
    files = _damaged(spark, sf_dir)
    known = files.where("path IN ('/corpus/4.rep', '/corpus/9.rep')").select(F.sha2("content", 256).alias("file_hash"))
    return catalog.outcomes(replays.ingest(files, known))


@_query("""WITH {EVENTS}, r AS (SELECT user_id, k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events_k)
SELECT CAST(user_id AS VARCHAR) AS capture, concat(count(*), ' input value(s) with bits outside 0x3FF (row ', min(i), ': p1_input=', arg_min(k, i) * 16, ')') AS detail FROM r WHERE k >= 64 GROUP BY user_id""")
def first_witness(spark, sf_dir):
    """The first mask that is out of range in each capture."""
    found = integrity.reports(captures.frames(_frame_texts(spark, sf_dir))).select("capture", F.explode("findings").alias("f"))
    return found.where("f.check = 'csv.mask_range'").select("capture", "f.detail")


@_query("""WITH {EVENTS}, r AS (SELECT *, k % 64 AS m, event_id % 11 = 0 AS flipped FROM events_k)
SELECT CAST(user_id AS VARCHAR) AS capture, count(*) AS csv_rows, count(*) FILTER (WHERE flipped) + count(*) FILTER (WHERE event_id % 4 = 0) AS mask_mismatches, round((count(*) - count(DISTINCT k)) / count(*), 9) AS duplicate_ratio FROM r GROUP BY user_id""")
def mask_parity(spark, sf_dir):
    """Masks against their own columns, of which only p1's are there."""
    mask = F.col("k") % 64
    # one column flipped in some rows
    said = F.when(F.col("event_id") % 11 == 0, mask.bitwiseXOR(F.lit(4))).otherwise(mask)
    cells = [F.col("k"), mask, F.when(F.col("event_id") % 4 == 0, 2).otherwise(0), *(bits.button(said, i) for i in range(len(BUTTONS)))]
    rows = _events(spark, sf_dir).select("user_id", "event_id", F.concat_ws(",", *(c.cast("string") for c in cells)).alias("line"))
    texts = rows.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "line"))).alias("rows"))
    header = "game_frame,p1_input,p2_input," + ",".join(f"p1_{b}" for b in BUTTONS) + "\n"
    files = texts.select(F.col("user_id").cast("string").alias("capture"), F.concat(F.lit(header), F.array_join(F.transform("rows", lambda r: r["line"]), "\n")).alias("value"))
    return integrity.reports(captures.frames(files)).select("capture", "csv_rows", "mask_mismatches", F.round("duplicate_ratio", 9).alias("duplicate_ratio"))


_OK = """c AS (SELECT user_id, event_id, k, lag(k) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events_k),
s AS (SELECT CAST(user_id AS VARCHAR) AS capture, count(*) AS n, count(DISTINCT k) AS d, count(*) FILTER (WHERE k < p) AS fell, count(*) FILTER (WHERE k >= 64) AS wide, max(k) AS top, max(event_id % 3) AS other FROM c GROUP BY user_id),
v AS (SELECT *, NOT (wide > 0 OR fell > 0 OR (n - d) * 10000 > n * 100 OR top = 0 AND other = 0) AS ok FROM s)"""


@_query(f"WITH {{EVENTS}}, {_OK} SELECT capture, concat('FAIL ', capture) AS verdict FROM v WHERE NOT ok")
def failing_captures(spark, sf_dir):
    """Only captures that fail, as text."""
    texts = sinks.report_text(integrity.failing(integrity.reports(captures.frames(_frame_texts(spark, sf_dir)))), failing_only=True)
    return texts.select("capture", F.substring_index("report", "\n", 1).alias("verdict"))


@_query(f"WITH {{EVENTS}}, {_OK} SELECT count(*) AS captures, count(*) FILTER (WHERE ok) AS passed FROM v")
def corpus_summary(spark, sf_dir):
    return integrity.corpus_summary(integrity.reports(captures.frames(_frame_texts(spark, sf_dir))))


@_query("""WITH v AS (SELECT DISTINCT l_orderkey AS v FROM lineitem), g AS (SELECT v, v - row_number() OVER (ORDER BY v) AS g FROM v), runs AS (SELECT min(v) AS start, count(*) AS length FROM g GROUP BY g)
SELECT start, length FROM runs ORDER BY length DESC, start LIMIT 10""")
def longest_runs_first(spark, sf_dir):
    """A report of the ten longest runs, of equally long ones the first."""
    return segments.ordered_runs(segments.contiguous_runs(_t(spark, sf_dir, "lineitem"), "l_orderkey")).limit(10)


@_query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'server_user_elo' WHEN 1 THEN 'id' WHEN 2 THEN 'mountain_vapor_bug' ELSE 'client_cards' END AS snake, coalesce(p_size % 3 = 1, false) AS strict,
CASE WHEN p_size % 2 = 0 THEN '/abs/x' ELSE '/root/rel/x' END AS path, p_size / nullif(p_size % 5, 0) IS NOT NULL AS has_rate FROM part""")
def scalar_texts(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    name = F.when(k % 4 == 0, "serverUserElo").when(k % 4 == 1, "id").when(k % 4 == 2, "mountainVaporBug").otherwise("clientCards")
    return _t(spark, sf_dir, "part").select(
        "p_partkey", scalars.snake_case(name).alias("snake"), bits.strictly_on(F.when(size % 3 == 2, "true").otherwise((size % 3).cast("string"))).alias("strict"),
        scalars.path_under(F.lit("/root/"), F.when(size % 2 == 0, "/abs/x").otherwise("rel/x")).alias("path"), (scalars.rate(size, size % 5) > 0).alias("has_rate"),
    )


@_query("""SELECT CAST(user_id AS VARCHAR) AS capture FROM (SELECT DISTINCT user_id FROM events) ORDER BY capture LIMIT 3""")
def newest_without_attempts(spark, sf_dir):
    """The first captures by name where no attempt is listed."""
    users = _t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("capture")).distinct()
    return planning.newest_or_by_name(users.withColumn("at", F.lit(1)).where("capture = 'none'"), users, 3, F.desc("at"))


def _stream_of(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.parquet(folder)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(folder)


def _run_to_end(stream: DataFrame, mode: str, out: str, checkpoint: str) -> DataFrame:
    """The rows of a stream that has read all there is; in complete mode those of the last batch."""

    def keep(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/batch={number}")

    stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def _arrive(batches: list[DataFrame], folder: str, files: int = 2) -> DataFrame:
    """A stream of the batches, written one after another as so many files each, which a trigger reads together."""
    for rows in batches:
        rows.repartition(files).write.mode("append").parquet(folder)
    schema = batches[0].schema
    return batches[0].sparkSession.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


@_query("""WITH e AS (SELECT event_id, event_id % 60 AS frames, max(event_id) OVER () AS top FROM events)
SELECT CAST(event_id // 5 * 5 AS BIGINT) AS start_s, count(*) AS n, CAST(sum(frames) AS BIGINT) AS frames FROM e WHERE NOT (event_id * 4 < top AND event_id % 7 = 0) AND event_id // 5 * 5 + 5 <= top - 60 GROUP BY 1""")
def stream_throughput(spark, sf_dir):
    """Frames of every five seconds that are over for a minute, in three batches; what comes after its interval was given is left out."""
    folder, at = _folder(spark), F.col("event_id")
    samples = _t(spark, sf_dir, "events").select("event_id", F.timestamp_seconds(at).alias("ts"), (at % 60).alias("frames"))
    top = samples.agg(F.max("event_id")).first()[0]
    late = (at * 4 < top) & (at % 7 == 0)
    batches = [samples.where((at * 2 < top) & ~late), samples.where(at * 2 >= top), samples.where(late)]
    rates = feeds.throughput_stream(_arrive(batches, f"{folder}/in"), late="1 minute")
    return _run_to_end(rates, "append", f"{folder}/out", f"{folder}/state").select(F.unix_timestamp("start").alias("start_s"), "n", "frames")


@_query("SELECT DISTINCT c_custkey % 700 AS id FROM customer")
def stream_listings(spark, sf_dir):
    """Each listed replay once, however often its line arrives."""
    folder = _folder(spark)
    sinks.append_listing(_t(spark, sf_dir, "customer").select((F.col("c_custkey") % 700).alias("id")).repartition(5), f"{folder}/in")
    return _run_to_end(feeds.listing_stream(spark, f"{folder}/in", 2), "append", f"{folder}/out", f"{folder}/state").select("id")


@_query("SELECT CAST(o_orderkey AS VARCHAR) AS replay_id, CASE WHEN o_orderstatus = 'F' THEN 'ok' ELSE 'failed' END AS status FROM orders WHERE o_orderkey % 9 <> 0")
def stream_attempts(spark, sf_dir):
    """Attempts as their files arrive, without torn lines."""
    folder, k = _folder(spark), F.col("o_orderkey")
    entry = F.to_json(F.struct(k.cast("string").alias("replay_id"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed").alias("status")))
    _t(spark, sf_dir, "orders").select(F.when(k % 9 == 0, F.substring(entry, 1, 12)).otherwise(entry).alias("value")).repartition(4).write.text(f"{folder}/in")
    return _run_to_end(feeds.attempt_stream(spark, f"{folder}/in", 1), "append", f"{folder}/out", f"{folder}/state").select("replay_id", "status")


@_query("SELECT concat('/data dir/', s_nationkey) AS root, s_name AS rel FROM supplier")
def stream_shipped(spark, sf_dir):
    """What the upload state lists once all that has arrived is shipped."""
    folder = _folder(spark)
    arrived = _t(spark, sf_dir, "supplier").select(F.concat(F.lit("/data dir/"), F.col("s_nationkey")).alias("root"), F.col("s_name").alias("rel"))
    stream = _stream_of(arrived.repartition(4), f"{folder}/in")
    feeds.ship(stream, f"{folder}/shipped", f"{folder}/state", lambda rows, number: rows.write.mode("overwrite").parquet(f"{folder}/uploaded/batch={number}")).awaitTermination()
    uploaded = spark.read.schema(arrived.schema).parquet(f"{folder}/uploaded")
    # all that is recorded has been uploaded before
    return captures.upload_state(spark, f"{folder}/shipped/*").join(uploaded.select("root", "rel"), ["root", "rel"], "left_semi")
