"""Queries over files that tasks write first and the library then finds, reads, appends to, packs or follows.

Inputs are written from the driver's tables into a new folder of the shared one, in whole files or in steps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog_queries import _EVENTS, _dealt, _decoded, _events, _frame_texts, _t
from .catalog_queries import ORACLES as CATALOG
from .file_queries import _arrive, _damaged, _folder, _run_to_end, _write_texts, _written
from .operators import integrity, planning, replays
from .plans import replay_tables
from .schemas import BUTTONS, PLAYERS
from .sources import captures, files, shards, sinks
from .streaming import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql.replace("{EVENTS}", _EVENTS)
        return f

    return add


_STATUS = "CASE WHEN o_orderstatus = 'F' THEN 'ok' ELSE 'failed' END"


@_query(f"SELECT concat('w', o_custkey % 100) AS worker, CAST(o_orderkey AS VARCHAR) AS replay_id, {_STATUS} AS status, o_orderkey % 1000 AS frames FROM orders")
def stream_grown_manifests(spark, sf_dir):
    """Manifests that are read, then grow in place, and are read on: each line once, those too that were being written."""
    folder, k = _folder(spark), F.col("o_orderkey")
    line = F.to_json(F.struct(k.cast("string").alias("replay_id"), F.expr(_STATUS).alias("status"), (k % 1000).alias("frames")))
    lines = _t(spark, sf_dir, "orders").select((F.col("o_custkey") % 100).alias("w"), F.struct((k % 4 == 0).cast("int").alias("step"), k.alias("k"), line.alias("line")).alias("r"))
    texts = lines.groupBy("w").agg(F.array_sort(F.collect_list("r")).alias("r")).select(F.concat(F.lit("w"), "w", F.lit("/manifest.jsonl")).alias("path"), "r")
    whole = lambda rows: F.array_join(F.transform(rows, lambda r: F.concat(r["line"], F.lit("\n"))), "")
    early, late = F.filter("r", lambda r: r["step"] == 0), F.filter("r", lambda r: r["step"] == 1)
    stream = lambda: _run_to_end(feeds.appended_attempts(spark, f"{folder}/corpus"), "append", f"{folder}/out", f"{folder}/state")
    _written(texts.select("path", F.concat(whole(early), F.coalesce(F.substring(F.try_element_at(late, F.lit(1))["line"], 1, 15), F.lit(""))).alias("value")), f"{folder}/corpus")
    stream()
    _written(texts.select("path", F.concat(whole(early), whole(late), F.lit('{"replay_id": "torn')).alias("value")), f"{folder}/corpus")
    return stream().select(F.element_at(F.split("path", "/"), -2).alias("worker"), "replay_id", "status", "frames")


@_query("""WITH {EVENTS}, l AS (SELECT user_id, event_id, k, coalesce(lag(k) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS p FROM events_k),
d AS (SELECT *, CAST(sum(CASE WHEN k < p THEN p ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS done FROM l)
SELECT user_id, event_id, done, k AS in_flight, done + k AS total FROM d""")
def stream_frame_totals(spark, sf_dir):
    """Frames of each worker so far, of counters that go back, in three batches."""
    folder = _folder(spark)
    samples = _events(spark, sf_dir).select("user_id", "event_id", "k")
    top = samples.agg(F.max("event_id")).first()[0]
    third = F.floor(F.col("event_id") * 3 / (top + 1))
    with feeds.keyed_state(spark):
        totals = feeds.frame_totals(_arrive([samples.where(third == n) for n in range(3)], f"{folder}/in"), "user_id", "k", ["event_id"])
        return _run_to_end(totals, "append", f"{folder}/out", f"{folder}/state").drop("batch")


@_query("SELECT id, min(n) AS first_n FROM (SELECT c_custkey % 700 AS id, c_custkey AS n FROM customer) GROUP BY id")
def stream_intake(spark, sf_dir):
    """Listings that shift from page to page against the index of what was seen; then all again, as after a lost checkpoint."""
    folder, k = _folder(spark), F.col("c_custkey")
    listed = _t(spark, sf_dir, "customer").select((k % 700).alias("id"), k.alias("n"))
    top = listed.agg(F.max("n")).first()[0]
    pages = lambda: _arrive([listed.where(F.floor(F.col("n") * 3 / (top + 1)) == n) for n in range(3)], f"{folder}/in")
    stream = pages()
    for state in ("state", "again"):
        feeds.intake(stream, f"{folder}/index", f"{folder}/{state}", order=("n",)).awaitTermination()
    return spark.read.schema(stream.schema.add("batch", "long")).parquet(f"{folder}/index").select("id", F.col("n").alias("first_n"))


@_query("""WITH RECURSIVE o AS (SELECT s_suppkey, s_suppkey % 97 * 10 + 1 AS s, row_number() OVER (ORDER BY s_suppkey) AS i FROM supplier),
r AS (SELECT i, s_suppkey, 0 AS bin, s AS total FROM o WHERE i = 1 UNION ALL
SELECT o.i, o.s_suppkey, CASE WHEN r.total > 0 AND r.total + o.s > 3000 THEN r.bin + 1 ELSE r.bin END, CASE WHEN r.total > 0 AND r.total + o.s > 3000 THEN o.s ELSE r.total + o.s END FROM r JOIN o ON o.i = r.i + 1)
SELECT printf('h-%04d.tar', bin + 7) AS shard, s_suppkey AS capture, s_suppkey % 97 * 10 + 1 AS length, sha256(repeat('x', CAST(s_suppkey % 97 * 10 AS INTEGER)) || chr(10)) AS sha256, s_suppkey % 1000 AS frames FROM r""")
def tar_shards(spark, sf_dir):
    """Captures on disk, packed into tar shards by tasks, and what is read back from shards, index and state."""
    folder, k = _folder(spark), F.col("s_suppkey")
    supplier = _dealt(spark, sf_dir, "supplier")
    _written(supplier.select(F.concat(F.lit("cap="), k, F.lit("/x.txt")).alias("path"), F.expr("repeat('x', cast(s_suppkey % 97 * 10 as int)) || chr(10)").alias("value")), f"{folder}/data")
    found = captures.file_sizes(spark, f"{folder}/data", "*.txt").select(F.regexp_extract("path", r"(cap=\d+)/", 1).alias("rel"), F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))
    listing = found.select(F.lit(f"{folder}/data").alias("root"), "rel", "file", "bytes")
    good = supplier.select(F.concat(F.lit("cap="), k).alias("rel"), k.alias("key"), (k % 1000).alias("frames"))
    plan = planning.shard_plan(listing.groupBy("root", "rel").agg(F.sum("bytes").alias("bytes")).join(good, "rel").withColumn("host", F.lit("h")), "host", ["key"], "bytes", 3000, first=7)
    spark.dataSource.register(shards.TarShards)
    shards.members_of(plan, listing).write.format("tar_shards").option("path", f"{folder}/out").mode("append").save()
    made = captures.file_sizes(spark, f"{folder}/out/shards", "*.tar").select("path")
    held = shards.contents(made).withColumn("rel", F.substring_index("name", "/", 1))
    index = spark.read.schema("root string, rel string, frames long").json(f"{folder}/out/index").select("rel", "frames")
    state = captures.upload_state(spark, f"{folder}/out/state").select("rel")
    return held.join(index, "rel").join(state, "rel", "left_semi").select("shard", F.substring_index("rel", "=", -1).cast("long").alias("capture"), "length", "sha256", "frames")


@_query("SELECT s_suppkey, s_suppkey % 50 * 1000 + 1 AS length, sha256(repeat('y', CAST(s_suppkey % 50 * 1000 AS INTEGER)) || chr(10)) AS sha256 FROM supplier WHERE s_suppkey % 5 <> 0 UNION ALL SELECT s_suppkey, NULL, NULL FROM supplier WHERE s_suppkey % 5 = 0")
def artefact_digests(spark, sf_dir):
    """Digests of listed files by blocks; some are not there."""
    folder, k = _folder(spark), F.col("s_suppkey")
    rows = _dealt(spark, sf_dir, "supplier").select(k, F.concat(F.lit("d/"), k, F.lit(".bin")).alias("path"), F.expr("repeat('y', cast(s_suppkey % 50 * 1000 as int)) || chr(10)").alias("value"))
    _written(rows.where(k % 5 != 0), folder)
    return files.file_digests(rows.select("s_suppkey", F.concat(F.lit(f"{folder}/"), "path").alias("path"))).drop("path")


@_query(f"""SELECT CAST(o_orderkey AS VARCHAR) AS replay_id, {_STATUS} AS status, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 1000 END AS frames, o_orderpriority AS priority, o_custkey % 10 AS second FROM orders WHERE o_orderkey % 7 <> 0""")
def whole_manifest_objects(spark, sf_dir):
    """Fields that no schema names, after the objects were read, written as they are, and read again; torn lines go."""
    folder, k = _folder(spark), F.col("o_orderkey")
    frames = F.when(k % 3 == 0, F.lit("many")).otherwise((k % 1000).cast("string"))
    entry = F.format_string('{"replay_id": "%s", "status": "%s", "frames": %s, "host": {"priority": "%s", "slots": [1, %s]}}', k, F.expr(_STATUS), F.when(k % 3 == 0, F.concat(F.lit('"'), frames, F.lit('"'))).otherwise(frames), "o_orderpriority", F.col("o_custkey") % 10)
    lines = _t(spark, sf_dir, "orders").select((k % 16).alias("w"), F.when(k % 7 == 0, F.substring(entry, 1, 30)).otherwise(entry).alias("value"))
    _write_texts(lines, f"{folder}/in", "w")
    sinks.append_objects(captures.manifest_objects(spark, f"{folder}/in", "*.txt"), f"{folder}/out")
    objects = captures.known_fields(captures.manifest_objects(spark, f"{folder}/out", "*.txt"), "replay_id", "status", "frames")
    return objects.select("replay_id", "status", "frames", F.try_variant_get("entry", "$.host.priority", "string").alias("priority"), F.try_variant_get("entry", "$.host.slots[1]", "bigint").alias("second"))


@_query("SELECT s_suppkey, s_suppkey % 300 + 1 AS length FROM supplier WHERE s_suppkey % 3 < 2")
def replay_discovery(spark, sf_dir):
    """Replay files anywhere below a root, by either case of their suffix."""
    k = F.col("s_suppkey")
    name = F.concat(F.lit("a/"), k % 5, F.lit("/r"), k, F.when(k % 3 == 0, ".rep").when(k % 3 == 1, ".REP").otherwise(".txt"))
    rows = _dealt(spark, sf_dir, "supplier").select(name.alias("path"), F.expr("repeat('z', cast(s_suppkey % 300 + 1 as int))").alias("value"))
    found = captures.replay_files(spark, _written(rows, _folder(spark)))
    return found.where(F.length("content") == F.col("length")).select(F.regexp_extract("path", r"/r(\d+)\.", 1).cast("long").alias("s_suppkey"), "length")


@_query("""WITH {EVENTS} SELECT CAST(user_id AS VARCHAR) AS capture, CASE user_id % 3 WHEN 0 THEN 'frame_index' WHEN 1 THEN 'local_frame' ELSE 'game_frame' END AS frame_column, count(*) AS n,
max(k) AS last_tick, CAST(sum(CASE WHEN event_id % 5 = 0 THEN 0 ELSE k END) AS BIGINT) AS p1_sum, CAST(0 AS BIGINT) AS n_failed FROM events_k GROUP BY user_id""")
def capture_folders(spark, sf_dir):
    """Frame tables of every generation of columns found below a root; empty cells are 0."""
    k, user = F.col("k"), F.col("user_id")
    line = F.concat_ws(",", k.cast("string"), F.when(F.col("event_id") % 5 == 0, "").otherwise(k.cast("string")), F.lit("1"))
    texts = _events(spark, sf_dir).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))).alias("rows"))
    header = F.concat(F.when(user % 3 == 0, "frame_index").when(user % 3 == 1, "local_frame").otherwise("game_frame"), F.lit(",p1_input,p2_input\n"))
    rows = texts.select(F.concat(user.cast("string"), F.lit("/inputs.csv")).alias("path"), F.concat(header, F.array_join(F.transform("rows", lambda r: r["line"]), "\n"), F.lit("\n")).alias("value"))
    frames = captures.frames(captures.frame_files(spark, _written(rows, _folder(spark))))
    return frames.groupBy("capture", "frame_column").agg(F.count("pos").alias("n"), F.max("tick").alias("last_tick"), F.sum("p1_input").alias("p1_sum"), F.count("failed").alias("n_failed"))


@_query("""SELECT CAST(user_id AS VARCHAR) AS capture, count(*) AS n, CAST(sum(CASE WHEN event_id % 3 = 0 THEN -1 ELSE event_id % 1000 END) AS BIGINT) AS numbers FROM events WHERE event_id % 4 <> 0 GROUP BY user_id""")
def legacy_images(spark, sf_dir):
    """Rows of the image era: those that name an image, and the number in its name."""
    n = F.col("event_id")
    image = F.when(n % 4 == 0, "").when(n % 3 == 0, "none.bmp").otherwise(F.concat(F.lit("f"), F.lpad((n % 1000).cast("string"), 6, "0"), F.lit("_9.bmp")))
    texts = _t(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct(n, F.concat_ws(",", n.cast("string"), image, F.lit("0"), F.lit("0")).alias("line")))).alias("rows"))
    rows = texts.select(F.col("user_id").cast("string").alias("capture"), F.concat(F.lit("frame_index,frame_file,p1_input,p2_input\n"), F.array_join(F.transform("rows", lambda r: r["line"]), "\n")).alias("value"))
    return captures.legacy_frames(captures.frames(rows)).groupBy("capture").agg(F.count("*").alias("n"), F.sum("number").alias("numbers"))


@_query(CATALOG["frame_rewrite"])
def written_frames(spark, sf_dir):
    """Frame tables as CSV, a folder for each capture, read back."""
    path = _folder(spark)
    sinks.write_frames(captures.frames(_frame_texts(spark, sf_dir)), path)
    flags = ", ".join(f"{p}_{b} int" for p in PLAYERS for b in BUTTONS)
    with captures.many_folders(spark):
        back = spark.read.schema(f"frame long, game_frame long, p1_input long, p2_input long, {flags}, capture string").option("header", True).csv(path)
    return back.select("capture", "frame", "game_frame", "p1_input", "p2_input", "p1_a", "p2_up")


@_query("""WITH b AS (SELECT i AS bit, ['up', 'down', 'left', 'right', 'a', 'b', 'c', 'd', 'change', 'spell'][i + 1] AS name FROM range(10) AS t(i)),
f AS (SELECT s_suppkey, i, (i * 7 + s_suppkey % 5000) & 1023 AS m FROM supplier, range(200) AS t(i) WHERE i < 100 + s_suppkey % 100)
SELECT name, '1' AS version, count(*) AS pressed, count(DISTINCT s_suppkey) AS replays FROM f JOIN b ON (m >> bit) & 1 = 1 GROUP BY name""")
def stored_replays(spark, sf_dir):
    """Replays and their frames as they are stored, with the dictionary of bits and the schema's version, by SQL over the views."""
    path = _folder(spark)
    sinks.write_replays(_decoded(spark, sf_dir), path)
    replay_tables.register(spark.read.parquet(f"{path}/replays"), spark.read.parquet(f"{path}/frame_inputs"))
    return spark.sql("SELECT name, max(value) AS version, count(*) AS pressed, count(DISTINCT replay_id) AS replays FROM frame_inputs JOIN input_format ON p1_input & mask <> 0 CROSS JOIN (SELECT value FROM schema_info WHERE key = 'version') GROUP BY name")


@_query("""SELECT concat(s_suppkey, '.rep') AS file_name, CASE s_suppkey % 5 WHEN 1 THEN 'Could not find compressed input data' WHEN 2 THEN 'No frame data in decompressed stream' ELSE 'Warning: all inputs are zero (possible parse error)' END AS parse_errors,
s_suppkey % 2 = 0 AS known FROM supplier WHERE s_suppkey % 5 IN (1, 2, 3)""")
def stored_errors(spark, sf_dir):
    """Errors of stored replays by the documented SQL, and which hashes of another list are there."""
    path, files_ = _folder(spark), _damaged(spark, sf_dir)
    sinks.write_replays(replays.decode(files_.where(F.substring_index(F.regexp_extract("path", r"(\d+)", 1), ".", 1).cast("long") % 5 > 0)), path)
    stored = spark.read.parquet(f"{path}/replays")
    replay_tables.register(stored, spark.read.parquet(f"{path}/frame_inputs"))
    asked = files_.where(F.regexp_extract("path", r"(\d+)", 1).cast("long") % 2 == 0).select(F.sha2("content", 256).alias("file_hash"))
    known = replay_tables.exists(stored, asked).join(stored.select("file_hash", "file_name"), "file_hash").select("file_name", F.lit(True).alias("known")).distinct()
    return spark.sql(replay_tables.WITH_ERRORS).join(known, "file_name", "left").select("file_name", "parse_errors", F.coalesce("known", F.lit(False)).alias("known"))


@_query(f"""WITH r AS ({CATALOG["validation_report"]})
SELECT capture, ok, CAST(CASE WHEN findings = '' THEN 1 ELSE 1 + len(string_split(findings, ',')) END AS INTEGER) AS n_lines, string_split(findings, ',')[1] AS first_line, (SELECT CAST(CASE WHEN bool_and(ok) THEN 0 ELSE 1 END AS INTEGER) FROM r) AS exit_code FROM r""")
def report_files(spark, sf_dir):
    """Reports as JSON and as lines to read, written and read back, with the exit code of all."""
    folder = _folder(spark)
    made = integrity.reports(captures.frames(_frame_texts(spark, sf_dir)))
    sinks.report_json(made).select(F.col("report").alias("value")).write.text(f"{folder}/json")
    told = spark.read.schema("capture string, ok boolean, findings array<struct<check:string,severity:string>>").json(f"{folder}/json")
    texts = sinks.report_text(made).select("capture", F.split("report", "\n").alias("lines"))
    line = F.regexp_extract(F.try_element_at("lines", F.lit(2)), r"^  (\w+) ([\w.]+): ", 0)
    first = F.coalesce(F.regexp_replace(line, r"^  (\w+) ([\w.]+): $", r"$2:$1"), F.lit(""))
    out = told.join(texts, "capture").where(F.size("findings") + 1 == F.size("lines"))
    return out.select("capture", "ok", F.size("lines").alias("n_lines"), first.alias("first_line"), F.lit(sinks.exit_code(made)).alias("exit_code"))
