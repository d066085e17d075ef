"""Manifests that grow in place, keyed counters, intake, tar shards, digests and variants."""

import hashlib
import json
import random
import tarfile

import pytest
from pyspark.sql import Row

from tickweave.sources import captures, files, growing, shards, sinks
from tickweave.streaming import feeds


def _run(stream, out, state):
    stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(state)).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(out))


def test_a_line_that_is_being_written_comes_once_and_whole(spark, tmp_path):
    root = tmp_path / "corpus"
    for w in "ab":
        (root / w).mkdir(parents=True)
    line = lambda i: json.dumps({"replay_id": f"r{i}", "status": "ok", "frames": i, "unknown": {"x": i}}) + "\n"
    (root / "a" / "manifest.jsonl").write_text(line(0) + "{torn\n" + line(1) + line(2)[:9])
    (root / "b" / "manifest.jsonl").write_text(line(3)[:5])
    (root / "b" / "other.txt").write_text(line(99))
    stream = lambda: feeds.appended_attempts(spark, str(root))
    first = _run(stream(), tmp_path / "out", tmp_path / "state")
    assert sorted(r["replay_id"] for r in first.collect()) == ["r0", "r1"]
    with open(root / "a" / "manifest.jsonl", "a") as f:
        f.write(line(2)[9:] + line(4))
    with open(root / "b" / "manifest.jsonl", "a") as f:
        f.write(line(3)[5:])
    (root / "c").mkdir()
    (root / "c" / "manifest.jsonl").write_text(line(5))
    again = _run(stream(), tmp_path / "out", tmp_path / "state")
    assert sorted((r["replay_id"], r["frames"]) for r in again.collect()) == [(f"r{i}", i) for i in range(6)]
    assert _run(stream(), tmp_path / "out", tmp_path / "state").count() == 6


@pytest.mark.parametrize("size", [1, 7, 100, 10**6])
def test_ranges_of_bytes_give_each_line_once(size, tmp_path):
    r = random.Random(size)
    lines = [b"x" * r.choice([0, 1, 3, 30]) + (b"\r" if r.random() < 0.2 else b"") for _ in range(60)]
    path = tmp_path / "f"
    path.write_bytes(b"".join(x + b"\n" for x in lines) + b"tail")
    reader = growing.LineReader(str(tmp_path), "f", size)
    end = reader.latestOffset()
    assert end == {str(path): path.stat().st_size - 4}
    got = [row for p in reader.partitions({}, end) for row in reader.read(p)]
    assert [v.encode() for _, _, v in got] == [x.removesuffix(b"\r") for x in lines]
    middle = {str(path): sum(len(x) + 1 for x in lines[:20])}
    assert [v for p in reader.partitions(middle, end) for _, _, v in reader.read(p)] == [v for _, _, v in got[20:]]


def test_counters_that_rewind(spark, tmp_path):
    def batch(n, rows):
        spark.createDataFrame(rows, "worker string, at long, n long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("worker string, at long, n long").parquet(str(tmp_path / "in"))
        with feeds.keyed_state(spark):
            return _run(feeds.frame_totals(stream, "worker", "n", ["at"]), tmp_path / "out", tmp_path / "state")

    batch(0, [("a", 2, 9), ("a", 1, 5), ("b", 1, 7), ("b", 3, None)])
    batch(1, [("a", 3, 2), ("a", 4, 2), ("a", 5, 1), ("c", 1, 0)])
    out = batch(2, [("b", 5, 8), ("a", 6, 30)])
    got = {(r["worker"], r["at"]): (r["done"], r["in_flight"], r["total"]) for r in out.collect()}
    assert got == {("a", 1): (0, 5, 5), ("a", 2): (0, 9, 9), ("a", 3): (9, 2, 11), ("a", 4): (9, 2, 11), ("a", 5): (11, 1, 12), ("a", 6): (11, 30, 41), ("b", 1): (0, 7, 7), ("b", 5): (0, 8, 8), ("c", 1): (0, 0, 0)}


def test_intake_is_idempotent_and_keeps_no_state(spark, tmp_path):
    path, index = str(tmp_path / "in"), str(tmp_path / "index")
    add = lambda ids: spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id long, n long").coalesce(1).write.mode("append").parquet(path)
    run = lambda state: feeds.intake(spark.readStream.schema("id long, n long").option("maxFilesPerTrigger", 1).parquet(path), index, str(tmp_path / state), order=("n",)).awaitTermination()
    seen = lambda: sorted(r["id"] for r in spark.read.parquet(index).collect())
    add([1, 2, 2, None])
    add([2, 3])
    run("state")
    assert seen() == [1, 2, 3]
    add([3, 4, 1])
    run("state")
    assert seen() == [1, 2, 3, 4] and not list((tmp_path / "state").glob("state/*"))
    run("lost")  # the checkpoint is lost: all batches run again
    assert seen() == [1, 2, 3, 4]


def _corpus(tmp_path, n=5):
    rows = []
    for i in range(n):
        folder = tmp_path / "data" / f"w{i % 2}" / f"cap {i}"
        folder.mkdir(parents=True)
        (folder / "inputs.csv").write_bytes(bytes([i]) * (1000 * i))
        (folder / "video.mp4").write_bytes(b"v" * 300_000)
        rows += [(f"h-{i // 2:04d}.tar", i, str(tmp_path / "data"), f"w{i % 2}/cap {i}", 60 * i, name) for name in ("inputs.csv", "video.mp4")]
    return rows


def test_shards_hold_what_the_plan_says(spark, tmp_path):
    rows = _corpus(tmp_path)
    spark.dataSource.register(shards.TarShards)
    df = spark.createDataFrame(rows, shards.MEMBERS)
    members = shards.members_of(df.drop("file").distinct(), df.select("root", "rel", "file"))
    members.write.format("tar_shards").option("path", str(tmp_path / "out")).mode("append").save()
    assert sorted(p.name for p in (tmp_path / "out" / "shards").iterdir()) == ["h-0000.tar", "h-0001.tar", "h-0002.tar"]
    for shard in {r[0] for r in rows}:
        want = [r for r in rows if r[0] == shard]
        with tarfile.open(tmp_path / "out" / "shards" / shard) as tar:
            assert tar.getnames() == [f"{r[3]}/{r[5]}" for r in want]
            assert all(tar.extractfile(m).read() == (tmp_path / "data" / m.name).read_bytes() for m in tar.getmembers())
        index = json.loads((tmp_path / "out" / "index" / f"{shard}.json").read_text())
        assert index == [{"root": r[2], "rel": r[3], "frames": r[4]} for r in want[::2]]
    state = captures.upload_state(spark, str(tmp_path / "out" / "state"))
    assert {(r["root"], r["rel"]) for r in state.collect()} == {(r[2], r[3]) for r in rows}
    assert not list((tmp_path / "out" / "tmp").iterdir())


def test_a_failed_task_leaves_no_shard_and_no_state(spark, tmp_path):
    rows = _corpus(tmp_path)
    (tmp_path / "data" / "w0" / "cap 4" / "video.mp4").unlink()
    spark.dataSource.register(shards.TarShards)
    df = spark.createDataFrame(rows, shards.MEMBERS).repartition(3, "shard").sortWithinPartitions("shard", "n", "file")
    with pytest.raises(Exception, match="cap 4"):
        df.write.format("tar_shards").option("path", str(tmp_path / "out")).mode("append").save()
    assert [p for p in (tmp_path / "out").rglob("*") if p.is_file()] == []


def test_a_failed_job_leaves_nothing_of_tasks_that_it_lost(tmp_path):
    rows = [Row(**dict(zip(("shard", "n", "root", "rel", "frames", "file"), r, strict=True))) for r in _corpus(tmp_path)]
    writer = shards.TarShards({"path": str(tmp_path / "out")}).writer(None, False)
    writer.write(iter(rows[:4]))  # its message doesn't reach the driver
    writer.abort([None])
    assert [p for p in (tmp_path / "out").rglob("*") if p.is_file()] == []
    with pytest.raises(OSError):
        writer.write(iter(rows[4:]))  # and another task begins too late
    assert [p for p in (tmp_path / "out").rglob("*") if p.is_file()] == []


def test_a_shard_of_two_tasks_is_refused(spark, tmp_path):
    rows = _corpus(tmp_path, 2)
    spark.dataSource.register(shards.TarShards)
    with pytest.raises(Exception, match="two tasks"):
        spark.createDataFrame(rows, shards.MEMBERS).repartition(2).write.format("tar_shards").option("path", str(tmp_path / "out")).mode("append").save()
    assert [p for p in (tmp_path / "out").rglob("*") if p.is_file()] == []


def test_digests_by_blocks(spark, tmp_path):
    data = random.Random(3).randbytes(5 * files.BLOCK // 2)
    (tmp_path / "large file").write_bytes(data)
    (tmp_path / "empty").write_bytes(b"")
    paths = [f"file:{tmp_path}/large%20file", str(tmp_path / "large file"), f"file://{tmp_path}/empty", str(tmp_path / "gone"), None]
    got = {r["path"]: (r["length"], r["sha256"]) for r in files.file_digests(spark.createDataFrame([(p,) for p in paths], "path string")).collect()}
    whole = (len(data), hashlib.sha256(data).hexdigest())
    assert got == dict(zip(paths, [whole, whole, (0, hashlib.sha256(b"").hexdigest()), (None, None), (None, None)], strict=True))
    assert max(map(len, files.blocks(str(tmp_path / "large file"), 1000))) == 1000


def test_unknown_fields_survive(spark, tmp_path):
    lines = [{"replay_id": "a", "status": "ok", "frames": 3, "extra": {"deep": [1, {"x": None}]}}, {"replay_id": "b", "frames": "many", "später": 1.5}]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "manifest.jsonl").write_text("\n".join(map(json.dumps, lines)) + '\n[1]\n"text"\n\n{"replay_id": "c')
    objects = captures.manifest_objects(spark, str(tmp_path / "w"))
    known = captures.known_fields(objects, "replay_id", "status", "frames")
    assert sorted((r["replay_id"], r["status"], r["frames"]) for r in known.collect()) == [("a", "ok", 3), ("b", None, None)]
    sinks.append_objects(objects, str(tmp_path / "back"))
    back = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "back")).collect()]
    assert sorted(back, key=lambda x: x["replay_id"]) == lines
