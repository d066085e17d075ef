"""Sources and sinks over real files, replay decoding and streams."""

import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tickweave.functions import scalars
from tickweave.operators import catalog, integrity, planning, replays, segments
from tickweave.plans import replay_tables
from tickweave.sources import captures, sinks
from tickweave.streaming import feeds


def test_frame_files_round_trip(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "inputs.csv").write_text("frame_index,frame_file,p1_input,p2_input\n" + "\n".join(f"{i},{i:06d}.bmp,{i % 4},{i % 3}" for i in range(20)))
    rows = captures.frames(captures.frame_files(spark, str(tmp_path)))
    assert rows.groupBy("capture").count().count() == 2
    assert [r["number"] for r in captures.legacy_frames(rows.where("capture = 'a'")).orderBy("pos").select("number").collect()] == list(range(20))
    sinks.write_frames(rows, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.count() == 40 and "p2_spell" in back.columns
    assert captures.frame_files(spark, str(tmp_path / "a")).count() == 1


def test_manifest_reads_around_torn_lines(spark, tmp_path):
    (tmp_path / "w1").mkdir()
    lines = [{"replay_id": "x-1", "status": "failed", "frames": 0}, {"replay_id": "x-1", "status": "ok", "frames": 7, "validation": {"csv_rows": 7}}, {"replay_id": "y-2", "status": "ok"}]
    (tmp_path / "w1" / "manifest.jsonl").write_text("\n".join(map(json.dumps, lines)) + '\n{"replay_id": "z')
    got = captures.manifests(spark, str(tmp_path)).orderBy("replay_id", "status").collect()
    assert [(r["replay_id"], r["status"], r["worker"]) for r in got] == [("x-1", "failed", "w1"), ("x-1", "ok", "w1"), ("y-2", "ok", "w1")]
    assert {r[0] for r in catalog.completed(captures.manifests(spark, str(tmp_path))).collect()} == {"x-1", "y-2"}
    numbered = captures.manifest_lines(spark, str(tmp_path / "w1" / "manifest.jsonl"))
    assert [r["replay_id"] for r in planning.newest(numbered.where("status = 'ok'"), 1, F.desc("line_no")).collect()] == ["y-2"]


def test_logs_status_and_state(spark, tmp_path):
    (tmp_path / "a.log").write_text("Session::init\nPerf: 1 fps, encoder wrote 900\nSession::init\nencoder wrote 5\nencoder wrote 60\n")
    (tmp_path / "b.log").write_text("Session::init\nnothing\n")
    got = {r["source_file"][-5:]: r["in_flight"] for r in captures.worker_logs(spark, str(tmp_path / "*.log")).collect()}
    assert got == {"a.log": 60, "b.log": None}
    runs = spark.createDataFrame([(None, "timeout", 1), (None, "exit", 3), ("{oops", "exit", 0), ('{"status":"ok","frames":9}', "exit", 0)], "status_text string, exit_reason string, exit_code int")
    out = [(r["status"], r["frames"]) for r in captures.run_status(runs).collect()]
    assert out == [("timeout", 0), ("failed", 0), ("failed", 0), ("ok", 9)]
    (tmp_path / "state.txt").write_text("/data/my root::w1/cap 1\n/data::w2/c\n")
    assert {(r["root"], r["rel"]) for r in captures.upload_state(spark, str(tmp_path / "state.txt")).collect()} == {("/data/my root", "w1/cap 1"), ("/data", "w2/c")}


def test_listing_pages_dedupe_and_filter(spark, tmp_path):
    pages = [[{"id": 1}, {"id": 2, "mountainVaporBug": True}], [{"id": 2, "mountainVaporBug": True}, {"id": 3, "serverUserNick": "n", "serverUserElo": 900.0}, {"id": 4}, {"id": 5}]]
    for i, p in enumerate(pages):
        (tmp_path / f"p{i}.json").write_text(json.dumps({"replays": p}))
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    got = planning.new_listings(captures.listing_pages(spark, str(tmp_path)), ids(4), ids(9), 3)
    assert [r["id"] for r in got.collect()] == [1, 3] and "serverUserNick" not in got.columns


def _replay(body: bytes, raw: bool = False) -> bytes:
    head = struct.pack("<I4xBB6x", 210, 3, 1) + struct.pack("<I2H", 2, 7, 300) + struct.pack("<BB5x", 25, 2) + struct.pack("<I1H", 1, 9) + bytes([4, 2]) + bytes(10)
    if raw:
        c = zlib.compressobj(wbits=-15)
        return head.ljust(0x80, b"\xff") + c.compress(body) + c.flush()
    return head.ljust(0x80, b"\xff") + zlib.compress(body)


def test_decode(spark):
    body = b"".join(struct.pack("<HH", (i * 3) | 0x400, i % 5) for i in range(70)) + b"\x01\x02"
    files = {"z": _replay(body), "r": _replay(body, True), "small": b"x" * 99, "none": b"\xff" * 300, "idle": _replay(bytes(4 * 61)), "short_deck": b"\x00" * 16 + b"\xff" * 84}
    got = {r["file_path"]: r for r in replays.decode(spark.createDataFrame([(k, bytearray(v)) for k, v in files.items()], "path string, content binary")).collect()}
    z = got["z"]
    assert (z["p1_character"], z["p2_character"], z["p1_deck_cards"], z["p2_deck_cards"], z["stage_name"], z["total_frames"], z["strategy"]) == ("Alice", "Unknown(25)", [7, 300], [9], "Netherworld", 70, "zlib")
    assert [f["p1"] for f in z["frames"]] == [i * 3 & 0x3FF for i in range(70)]
    assert got["r"]["strategy"] == "deflate"
    assert got["small"]["parse_errors"] == ["File too small (99 bytes)"]
    assert "Could not find compressed input data" in got["none"]["parse_errors"]
    assert got["idle"]["parse_errors"] == ["Warning: all inputs are zero (possible parse error)"]


def test_ingest_and_sql(spark, tmp_path):
    body = b"".join(struct.pack("<HH", 16 if i % 2 else 1, 0) for i in range(70))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.REP").write_bytes(_replay(body))
    (tmp_path / "b.rep").write_bytes(b"tiny")
    (tmp_path / "c.txt").write_bytes(b"no")
    files = captures.replay_files(spark, str(tmp_path))
    assert files.count() == 2
    first = replays.ingest(files, spark.createDataFrame([], "file_hash string"))
    assert {r["outcome"] for r in first.collect()} == {"success", "failed"}
    done = first.where("outcome = 'success'").select("file_hash")
    assert catalog.outcomes(replays.ingest(files, done)).first().asDict() == {"total": 2, "success": 0, "failed": 1, "skipped": 1}
    sinks.write_replays(first.where("outcome = 'success'"), str(tmp_path / "db"))
    dim, frames = spark.read.parquet(str(tmp_path / "db/replays")), spark.read.parquet(str(tmp_path / "db/frame_inputs"))
    replay_tables.register(dim, frames)
    rid = dim.first()["replay_id"]
    assert spark.sql(replay_tables.FRAMES_WITH_A, {"replay": rid}).count() == 35
    assert spark.sql(replay_tables.DIRECTIONS, {"replay": rid}).where("direction = 1").count() == 35
    assert spark.sql(replay_tables.MATCHUPS).first()["n"] == 1
    assert spark.sql(replay_tables.WITH_ERRORS).count() == 0
    assert replay_tables.exists(dim, done).count() == 1


def test_plans(spark):
    caps = spark.createDataFrame([("h", i, s, f"r{i}") for i, s in enumerate([50, 60, 200, 10, 10, 80, 20])], "host string, k int, size int, rel string")
    got = planning.shard_plan(caps.withColumn("root", F.lit("/r")).withColumn("frames", F.lit(1)), "host", ["k"], "size", 100, 2)
    assert [r["bin"] for r in got.orderBy("n").collect()] == [0, 1, 2, 3, 3, 3, 4]
    index = sinks.shard_index(got.withColumnRenamed("size", "bytes"))
    assert json.loads(index.where("shard = 'h-0005.tar'").first()["index_json"])[0]["rel"] == "r3"
    assert captures is not None and caps.select(scalars.shard_index(F.lit("h-0012.tar"))).first()[0] == 12
    shard = planning.stride_shard(caps, 1, 3, "k")
    assert [r["k"] for r in shard.orderBy("k").collect()] == [1, 4]
    runs = segments.contiguous_runs(spark.createDataFrame([(v,) for v in (5, 1, 2, 3, 9, 10, 20)], "v long"), "v")
    assert {(r["start"], r["length"]) for r in runs.collect()} == {(1, 3), (5, 1), (9, 2), (20, 1)}
    dup = segments.contiguous_runs(spark.createDataFrame([("a", i, v) for i, v in enumerate((1, 2, 2, 3))], "k string, i int, v long"), "v", ["k"], "i")
    assert sorted((r["start"], r["length"]) for r in dup.collect()) == [(1, 2), (2, 2)]
    assert segments.busiest_window(spark.createDataFrame([("a", i, 1) for i in range(3)], "k string, i int, v long"), "k", "i", "v", 5).first()["start"] == 0


def test_reports_to_json_and_exit_code(spark):
    files = spark.createDataFrame([("a", "frame,game_frame\n")], "capture string, value string")
    checked = integrity.reports(captures.frames(files))
    assert sinks.exit_code(checked) == 1 and json.loads(sinks.report_json(checked).first()["report"])["capture"] == "a"
    assert sinks.exit_code(checked.limit(0)) == 2


def test_streams(spark, tmp_path):
    src, state = tmp_path / "in", tmp_path / "state"
    src.mkdir()
    (src / "1.json").write_text('{"root":"/r","rel":"a"}\n{"root":"/r","rel":"b"}\n')
    batches = []
    rows = spark.readStream.schema("root string, rel string").json(str(src))
    feeds.ship(rows, str(state), str(tmp_path / "ck"), lambda df, n: batches.append((n, df.count()))).awaitTermination()
    (src / "2.json").write_text('{"root":"/r","rel":"c"}\n')
    feeds.ship(rows, str(state), str(tmp_path / "ck"), lambda df, n: batches.append((n, df.count()))).awaitTermination()
    assert batches == [(0, 2), (1, 1)]
    shipped = captures.upload_state(spark, str(state / "*"))
    assert planning.not_shipped(spark.createDataFrame([("/r", "c"), ("/r", "d")], "root string, rel string"), shipped).count() == 1
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "1.json").write_text('{"id":1}\n{"id":1}\n{bad\n{"id":2}\n')
    q = feeds.listing_stream(spark, str(tmp_path / "m")).writeStream.format("memory").queryName("listed").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r["id"] for r in spark.sql("select id from listed").collect()} == {1, 2}
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.json").write_text('{"replay_id":"x","status":"ok"}\n{"repl')
    q = feeds.attempt_stream(spark, str(tmp_path / "a")).writeStream.format("memory").queryName("attempts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select * from attempts").count() == 1
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "1.json").write_text("".join(f'{{"ts":"2024-01-01T00:00:0{i}Z","frames":{i}}}\n' for i in (0, 4, 5, 9)))
    samples = spark.readStream.schema("ts timestamp, frames long").json(str(tmp_path / "s"))
    q = feeds.throughput_stream(samples).writeStream.format("memory").queryName("rates").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    q.stop()
    assert [(r["n"], r["frames"]) for r in spark.sql("select * from rates order by start").collect()] == [(2, 4), (2, 14)]


def test_packing_streams_each_group(spark):
    from tickweave.operators import planning

    rows = spark.createDataFrame([("a", i, s) for i, s in enumerate([5, 5, 1, 20, 3, 7, None])] + [("b", 0, 10), (None, 0, 1)], "host string, i int, size int")
    got = {(r["host"], r["i"]): (r["n"], r["bin"]) for r in planning.next_fit(rows, "host", ["i"], "size", 10).collect()}
    assert [got["a", i][1] for i in range(7)] == [0, 0, 1, 2, 3, 3, 3] and all(got["a", i][0] == i for i in range(7))
    assert got["b", 0] == got[None, 0] == (0, 0)


def test_budget_over_ranges(spark):
    from tickweave.operators import planning

    rows = spark.range(5000).selectExpr("id", "id % 7 AS amount").repartition(9)
    total, want = 0, []
    for i in range(5000):
        if total < 4000:
            want.append(i)
        total += i % 7
    assert sorted(r["id"] for r in planning.within_budget(rows, "amount", 4000, "id").collect()) == want


def test_reports_as_text(spark):
    files = spark.createDataFrame([("a", "frame,game_frame\n"), ("b", "frame,game_frame,p1_input,p2_input\n" + "\n".join(f"{i},{i},1,1" for i in range(600)))], "capture string, value string")
    checked = integrity.reports(captures.frames(files))
    texts = {r["capture"]: r["report"] for r in sinks.report_text(checked).collect()}
    assert texts == {"a": "FAIL a\n  error csv.rows: no data rows", "b": "pass b"}
    assert [r["capture"] for r in sinks.report_text(checked, failing_only=True).collect()] == ["a"]


def test_a_cluster_needs_a_shared_folder(spark):
    from types import SimpleNamespace

    from tickweave import storage

    def session(master, where=None):
        conf = SimpleNamespace(get=lambda *a: where)
        sc = SimpleNamespace(master=master, getConf=lambda: conf, getCheckpointDir=lambda: None, setCheckpointDir=lambda x: None)
        return SimpleNamespace(conf=conf, sparkContext=sc)

    assert storage.shared_dir(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert storage.shared_dir(session("local[*]"))
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError):
            storage.shared_dir(session(master))
