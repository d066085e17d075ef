"""Queries over keys of larger tables, where made contents once repeated, and how work is dealt out."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tickweave import catalog_queries, file_queries, storage_queries
from tickweave.operators import replays
from tickweave.plans import replay_tables
from tickweave.sources import sinks

MODULES = (catalog_queries, file_queries, storage_queries)
QUERIES, ORACLES = {k: v for m in MODULES for k, v in m.QUERIES.items()}, {k: v for m in MODULES for k, v in m.ORACLES.items()}
KEYS = (4, 7, 9, 13, 5007, 10007, 55004, 55009, 55013, 110009)


@pytest.fixture
def suppliers(spark, tmp_path):
    spark.createDataFrame([(k,) for k in KEYS], "s_suppkey long").coalesce(1).write.parquet(str(tmp_path / "sf" / "supplier.parquet"))
    return str(tmp_path / "sf")


@pytest.mark.parametrize("name", ["decoded_frames", "stored_replays", "ingest_outcomes", "stored_errors", "log_frames", "artefact_sizes", "tar_shards"])
def test_same_rows_for_keys_far_apart(spark, suppliers, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM '{suppliers}/supplier.parquet/*.parquet'")
    df = QUERIES[name](spark, suppliers)
    cur = con.execute(ORACLES[name])
    at = [[d[0] for d in cur.description].index(c) for c in df.columns]
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=str)


def test_files_of_equal_content_are_replays_of_their_own(spark):
    made = spark.createDataFrame([(4,)], "s_suppkey long").mapInPandas(file_queries._broken_replays, "path string, content binary")
    decoded = replays.decode(made.withColumn("path", F.explode(F.array(F.lit("/a/1.rep"), F.lit("/b/1.rep")))))
    ids = {r[0] for r in replay_tables.replay_dimension(decoded).select("replay_id").collect()}
    assert len(ids) == 2
    assert {r["replay_id"]: r["count"] for r in replay_tables.frame_inputs(decoded).groupBy("replay_id").count().collect()} == dict.fromkeys(ids, 5)
    assert replay_tables.replay_dimension(decoded).select("file_hash").distinct().count() == 1


def test_stored_frames_are_not_sent_through_the_driver(spark, suppliers):
    key = "spark.sql.maxBroadcastTableSize"
    spark.conf.set(key, "4k")  # the dictionary of bits fits it, the frames of ten replays don't
    try:
        rows = QUERIES["stored_replays"](spark, suppliers).collect()
    finally:
        spark.conf.unset(key)
    assert len(rows) == 10 and {r["version"] for r in rows} == {"1"}


def test_few_small_rows_are_decoded_by_all_tasks(spark, suppliers):
    for made in (catalog_queries._decoded(spark, suppliers), file_queries._damaged(spark, suppliers)):
        assert made.rdd.getNumPartitions() == 4


def test_decoded_rows_come_in_batches(spark):
    made = spark.createDataFrame([(k,) for k in range(3, 3000, 5)], "s_suppkey long").coalesce(1).mapInPandas(file_queries._broken_replays, "path string, content binary")
    out = replays.decode(made)
    assert out.agg(F.count("*"), F.sum("total_frames"), F.sum(F.size("frames"))).first()[0] == 600
    assert out.where("total_frames != size(frames)").count() == 0


def test_written_frames_replace_a_table_and_keep_any_name(spark, tmp_path):
    names = ["a", "x/y=z:1", "ü [1]^", "50%"]
    rows = spark.createDataFrame([(c, i, i, 1, 2) for c in names for i in (1, 0)], "capture string, pos int, tick long, p1_input long, p2_input long").repartition(3)
    path = str(tmp_path / "out")
    sinks.write_frames(rows.withColumn("capture", F.concat("capture", F.lit("old"))), path)
    sinks.write_frames(rows, path)
    back = spark.read.option("header", True).csv(path)
    assert sorted((r["capture"], r["frame"], r["p1_up"], r["p2_down"]) for r in back.collect()) == sorted((c, i, "1", "1") for c in names for i in "01")
    # written by the tasks: a file for each capture and no file of checksums beside it
    assert sorted(p.name for p in tmp_path.rglob("*") if p.is_file()) == ["inputs.csv"] * len(names)
