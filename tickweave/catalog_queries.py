"""Every capture operator as a query over the driver's tables, with SQL for the same rows.

The tables stand in for captures: a user's events are a capture's rows (event_id their order, props.k the
tick or the mask), orders are attempts at a capture, customers the corpus.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import bits, scalars
from .operators import catalog, integrity, planning, replays, segments
from .plans import replay_tables
from .schemas import STAGES
from .sources import captures, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql.replace("{EVENTS}", _EVENTS)
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are few bytes but become files, dealt evenly over all tasks."""
    return _t(spark, sf_dir, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return _t(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", k.alias("k"))


_EVENTS = """events_k AS (SELECT user_id, event_id, ts, event_type, CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT) AS k FROM events)"""


@_query("""WITH {EVENTS}, l AS (SELECT *, lag(k) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events_k)
SELECT user_id, count(*) AS csv_rows, count(DISTINCT k) AS distinct_frames, count(*) FILTER (WHERE k < p) AS decreases,
       count(*) - count(DISTINCT k) AS duplicate_rows FROM l GROUP BY user_id""")
def integrity_summary(spark, sf_dir):
    return integrity.tick_summary(_events(spark, sf_dir), "user_id", "event_id", "k")


@_query("""WITH {EVENTS}, c AS (SELECT user_id, k, count(*) AS n, min(event_id) AS f FROM events_k GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS rn FROM c)
SELECT user_id, k AS worst_value, n AS worst_count FROM r WHERE rn = 1""")
def worst_duplicate(spark, sf_dir):
    return integrity.worst_duplicate(_events(spark, sf_dir), "user_id", "event_id", "k")


@_query("WITH {EVENTS} SELECT event_id, " + ", ".join(f"CAST((k >> {i}) & 1 AS INTEGER) AS p1_{b}" for i, b in enumerate(("up", "down", "left", "right", "a", "b", "c", "d", "change", "spell"))) + " FROM events_k")
def mask_decompose(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", *bits.buttons(F.col("k"), "p1"))


@_query("WITH {EVENTS} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS mismatches, CAST(sum(k) AS BIGINT) AS mask_sum FROM events_k")
def mask_roundtrip(spark, sf_dir):
    back = bits.mask_of([bits.button(F.col("k"), i) for i in range(10)]).cast("long")
    rows = _events(spark, sf_dir).select("k", back.alias("back"))
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(F.expr("k != back")).alias("mismatches"), F.sum("back").alias("mask_sum"))


@_query("WITH {EVENTS} SELECT user_id, count(*) AS violations, min(event_id) AS first_event FROM events_k WHERE (k & 64) <> 0 GROUP BY user_id")
def mask_range(spark, sf_dir):
    bad = _events(spark, sf_dir).where(bits.out_of_range(F.col("k"), 63))
    return bad.groupBy("user_id").agg(F.count("*").alias("violations"), F.min("event_id").alias("first_event"))


@_query("WITH {EVENTS} SELECT event_id, k & 15 AS direction, k & 1008 AS pressed FROM events_k")
def direction_mask(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", bits.direction(F.col("k")).alias("direction"), bits.pressed(F.col("k")).alias("pressed"))


@_query("WITH {EVENTS} SELECT event_id, k FROM events_k WHERE user_id = 7 AND (k & 16) <> 0")
def button_pressed(spark, sf_dir):
    return _events(spark, sf_dir).where((F.col("user_id") == 7) & (bits.button(F.col("k"), 4) == 1)).select("event_id", "k")


@_query("""WITH {EVENTS} SELECT event_id, array_to_string(list_filter([CASE WHEN (k & 1) <> 0 THEN 'up' END, CASE WHEN (k & 2) <> 0 THEN 'down' END,
CASE WHEN (k & 4) <> 0 THEN 'left' END, CASE WHEN (k & 8) <> 0 THEN 'right' END, CASE WHEN (k & 16) <> 0 THEN 'a' END, CASE WHEN (k & 32) <> 0 THEN 'b' END,
CASE WHEN (k & 64) <> 0 THEN 'c' END], lambda x: x IS NOT NULL), ',') AS held FROM events_k""")
def held_inputs(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", F.array_join(bits.held(F.col("k")), ",").alias("held"))


@_query("""WITH {EVENTS} SELECT event_id, (CASE WHEN k - 50 < 0 THEN 1 ELSE 0 END) + (CASE WHEN k - 50 > 0 THEN 2 ELSE 0 END) + (CASE WHEN k % 3 - 1 < 0 THEN 4 ELSE 0 END)
 + (CASE WHEN k % 3 - 1 > 0 THEN 8 ELSE 0 END) + (CASE WHEN k % 2 > 0 THEN 16 + 64 + 256 ELSE 0 END) + (CASE WHEN k % 5 > 0 THEN 32 + 128 + 512 ELSE 0 END) AS mask FROM events_k""")
def axes_to_mask(spark, sf_dir):
    k = F.col("k")
    return _events(spark, sf_dir).select("event_id", bits.from_axes(k - 50, k % 3 - 1, [k % 2, k % 5] * 3).alias("mask"))


@_query("""WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM conversations)
SELECT conv_id AS id, 'conversation' AS kind, count(*) AS n_rows, count(*) FILTER (WHERE place <> turn) = 0 AS dense, min(place) FILTER (WHERE place <> turn) AS first_mismatch FROM c GROUP BY conv_id
UNION ALL SELECT user_id, 'events', count(*), count(*) FILTER (WHERE place <> k) = 0, min(place) FILTER (WHERE place <> k)
FROM (WITH {EVENTS} SELECT user_id, k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS place FROM events_k) GROUP BY user_id""")
def dense_counter(spark, sf_dir):
    turns = integrity.dense_counter(_t(spark, sf_dir, "conversations").select("conv_id", "turn"), "conv_id", "turn", "turn")
    ticks = integrity.dense_counter(_events(spark, sf_dir), "user_id", "event_id", "k")
    named = lambda df, key, kind: df.select(F.col(key).cast("long").alias("id"), F.lit(kind).alias("kind"), "n_rows", "dense", "first_mismatch")
    return named(turns, "conv_id", "conversation").unionByName(named(ticks, "user_id", "events"))


@_query("""WITH {EVENTS} SELECT user_id, count(*) AS n_rows, count(*) FILTER (WHERE k <> 0) AS active_rows, count(DISTINCT k) AS distinct_states,
count(*) FILTER (WHERE k <> 0) = 0 AND count(*) > 60 AS all_idle FROM events_k GROUP BY user_id""")
def activity_profile(spark, sf_dir):
    return integrity.activity(_events(spark, sf_dir), "user_id", "k")


@_query("""WITH l AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 1 ELSE 0 END AS c FROM events),
g AS (SELECT user_id, sum(c) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM l), r AS (SELECT user_id, run, count(*) AS n FROM g GROUP BY ALL)
SELECT user_id, CAST(sum(n) AS BIGINT) AS n_rows, max(n) AS longest FROM r GROUP BY user_id""")
def longest_identical_run(spark, sf_dir):
    return segments.longest_identical(_t(spark, sf_dir, "events"), "user_id", "event_id", "event_type")


_RUNS = """v AS (SELECT DISTINCT l_orderkey AS v FROM lineitem), g AS (SELECT v, v - row_number() OVER (ORDER BY v) AS g FROM v),
runs AS (SELECT min(v) AS start, count(*) AS length FROM g GROUP BY g)"""


@_query(f"WITH {_RUNS} SELECT start, length FROM runs")
def contiguous_runs(spark, sf_dir):
    return segments.contiguous_runs(_t(spark, sf_dir, "lineitem"), "l_orderkey")


@_query(f"WITH {_RUNS} SELECT start, length FROM runs ORDER BY length DESC, start LIMIT 1")
def longest_contiguous_run(spark, sf_dir):
    return segments.longest_run(segments.contiguous_runs(_t(spark, sf_dir, "lineitem"), "l_orderkey"))


@_query("""WITH {EVENTS}, n AS (SELECT user_id, event_id, k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events_k),
l AS (SELECT *, CASE WHEN k = lag(k) OVER (PARTITION BY user_id ORDER BY event_id) + 1 THEN 0 ELSE 1 END AS b FROM n),
g AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM l),
r AS (SELECT user_id, arg_min(k, event_id) AS start, count(*) AS length FROM g GROUP BY user_id, run)
SELECT user_id, start, length FROM r""")
def runs_by_capture(spark, sf_dir):
    return segments.contiguous_runs(_events(spark, sf_dir), "k", ["user_id"], "event_id")


@_query("""WITH {EVENTS}, w AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n,
sum(bit_count(k) + bit_count(event_id % 1024)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS s FROM events_k),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, i) AS rn FROM w WHERE i = 0 OR i < n - 5)
SELECT user_id, i AS start, CAST(s AS BIGINT) AS total FROM r WHERE rn = 1""")
def busiest_window(spark, sf_dir):
    rows = _events(spark, sf_dir).withColumn("held", bits.density(F.col("k"), F.col("event_id") % 1024).cast("long"))
    return segments.busiest_window(rows, "user_id", "event_id", "held", 5)


@_query("""WITH {EVENTS}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events_k)
SELECT user_id, p AS percent, CAST(i AS BIGINT) AS i, event_id FROM n, (VALUES (15), (40), (65), (90)) AS t(p) WHERE i = n * p // 100""")
def positional_samples(spark, sf_dir):
    out = segments.positional_samples(_events(spark, sf_dir), "user_id", "event_id")
    return out.select("user_id", "percent", F.col("i").cast("long").alias("i"), "event_id")


@_query("""WITH a AS (SELECT o_orderpriority AS worker, o_orderstatus = 'F' AS ok, o_orderkey % 1000 AS frames FROM orders)
SELECT worker, count(*) FILTER (WHERE ok) AS n_ok, count(*) FILTER (WHERE NOT ok) AS n_failed, CAST(coalesce(sum(frames) FILTER (WHERE ok), 0) AS BIGINT) AS total_frames FROM a GROUP BY ROLLUP (worker)""")
def status_rollup(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("worker"), "o_orderstatus", (F.col("o_orderkey") % 1000).alias("frames"))
    return catalog.status_rollup(rows, "worker", F.col("o_orderstatus") == "F", "frames")


@_query("""SELECT o_orderpriority AS host, count(*) AS captures, sum(o_orderkey % 1000) / 60 / 3600 AS hours, (epoch(max(o_orderdate)) - epoch(min(o_orderdate))) / 3600 AS wall_hours,
CASE WHEN count(*) < 2 OR max(o_orderdate) = min(o_orderdate) THEN 0 ELSE sum(o_orderkey % 1000) / 60 / 3600 / ((epoch(max(o_orderdate)) - epoch(min(o_orderdate))) / 3600) END AS rate
FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""")
def hours_and_rate(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderpriority").alias("host"), "o_orderdate", (F.col("o_orderkey") % 1000).alias("frames"))
    return catalog.throughput(rows, "host", "o_orderdate", "frames")


def _attempts(spark, sf_dir):
    """Orders as attempts at a customer's capture."""
    return _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("replay_id"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed").alias("status"))


@_query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def resume_anti(spark, sf_dir):
    return catalog.to_do(_t(spark, sf_dir, "customer").select("c_custkey"), _attempts(spark, sf_dir), "c_custkey")


@_query("SELECT c_name AS stem FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def prune_semi(spark, sf_dir):
    names = _t(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("stem"))
    ids = _attempts(spark, sf_dir).withColumnRenamed("replay_id", "c_custkey").join(names, "c_custkey").select(F.concat(scalars.sanitized(F.col("stem")), F.lit("-0123abcd")).alias("replay_id"), "status")
    return catalog.to_prune(names.select("stem"), ids)


@_query("SELECT doc_id AS path FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphans(spark, sf_dir):
    return catalog.orphans(_t(spark, sf_dir, "documents").select(F.col("doc_id").alias("path")), _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("video")))


@_query("""SELECT o_orderkey, o_orderkey % 7 + 1 AS video_frames, n AS csv_rows FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
WHERE n IS DISTINCT FROM o_orderkey % 7 + 1""")
def sync_mismatch(spark, sf_dir):
    left = _t(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 7 + 1).alias("video_frames"))
    right = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("csv_rows"))
    return catalog.count_mismatches(left, right, "o_orderkey", "video_frames", "csv_rows")


@_query("""SELECT CASE WHEN l.doc_id IS NULL THEN 'unverifiable' WHEN d.doc_id % 11 = 0 THEN 'missing' WHEN d.doc_id % 13 = 0 THEN 'mismatch' ELSE 'ok' END AS state, count(*) AS n
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def digest_audit(spark, sf_dir):
    docs, labels = _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("labelled"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    path = F.col("doc_id").cast("string")
    attempts = docs.join(labels, "doc_id", "left").select(path.alias("replay_id"), F.lit("ok").alias("status"), path.alias("video"), F.when(F.col("labelled"), digest).alias("video_sha256"), F.lit(None).cast("string").alias("csv"), F.lit(None).cast("string").alias("csv_sha256"))
    files = docs.where("doc_id % 11 != 0").select(path.alias("path"), F.when(F.col("doc_id") % 13 == 0, "0").otherwise(digest).alias("sha256"))
    return catalog.digest_audit(attempts, files).groupBy("state").agg(F.count("*").alias("n"))


@_query("""SELECT count(*) AS checked, count(*) FILTER (WHERE l.doc_id IS NOT NULL AND d.doc_id % 11 <> 0) AS verified, count(*) FILTER (WHERE l.doc_id IS NULL) AS unverifiable,
count(*) FILTER (WHERE l.doc_id IS NOT NULL AND d.doc_id % 11 = 0) AS problems FROM documents d LEFT JOIN labels l USING (doc_id)""")
def audit_tally(spark, sf_dir):
    docs, labels = _t(spark, sf_dir, "documents").select("doc_id"), _t(spark, sf_dir, "labels").select("doc_id", F.lit("d").alias("video_sha256"))
    path = F.col("doc_id").cast("string")
    attempts = docs.join(labels, "doc_id", "left").select(path.alias("replay_id"), F.lit("ok").alias("status"), path.alias("video"), "video_sha256", F.lit(None).cast("string").alias("csv"), F.lit(None).cast("string").alias("csv_sha256"))
    audit = catalog.digest_audit(attempts, docs.where("doc_id % 11 != 0").select(path.alias("path"), F.lit("d").alias("sha256")))
    return catalog.audit_tally(audit, attempts)


@_query("""SELECT doc_id, CASE WHEN toxic = 1 THEN 'mountainVaporBug' WHEN quality = 0 THEN 'unranked' WHEN least(doc_id % 50, doc_id % 70) * 100 < 1000
THEN concat('elo ', least(doc_id % 50, doc_id % 70) * 100, ' < 1000') END AS reason FROM labels""")
def usable_filter(spark, sf_dir):
    rows = _t(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("mountainVaporBug"), (F.col("quality") == 0).alias("unranked"), (F.col("doc_id") % 50 * 100.0).alias("serverUserElo"), (F.col("doc_id") % 70 * 100.0).alias("clientUserElo"))
    return rows.select("doc_id", planning.unusable_reason(True, 1000.0).alias("reason"))


@_query("SELECT doc_id, concat(substr(regexp_replace(source, '[^a-zA-Z0-9_-]', '_', 'g'), 1, 60), '-', substr(sha256(text), 1, 8)) AS capture_id, sha256(text) AS digest FROM documents")
def capture_id(spark, sf_dir):
    text = F.col("text").cast("binary")
    return _t(spark, sf_dir, "documents").select("doc_id", scalars.capture_id(F.col("source"), text).alias("capture_id"), F.sha2(text, 256).alias("digest"))


@_query("SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents GROUP BY sha256(text)")
def content_dedup(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    return planning.keep_first(rows, "digest", "doc_id")


@_query("SELECT page_id, rn FROM (SELECT page_id, row_number() OVER (ORDER BY url COLLATE \"C\", page_id) - 1 AS rn FROM pages) WHERE rn % 4 = 1".replace(' COLLATE "C"', ""))
def stride_shard(spark, sf_dir):
    return planning.stride_shard(_t(spark, sf_dir, "pages").select("url", "page_id"), 1, 4, "url", "page_id").select("page_id", "rn")


@_query("""WITH s AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS rn FROM customer)
SELECT c_custkey FROM s WHERE rn % 3 = 2 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') ORDER BY rn LIMIT 20""")
def resumed_work_list(spark, sf_dir):
    return planning.work_list(_t(spark, sf_dir, "customer").select("c_custkey"), _attempts(spark, sf_dir), 2, 3, 20, "c_custkey").select("c_custkey")


@_query("SELECT n_nationkey AS a, c_mktsegment AS b, min(n_name) AS a_name, min(c_mktsegment) AS b_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey, c_mktsegment")
def matchup_counts(spark, sf_dir):
    rows = _t(spark, sf_dir, "customer").join(_t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return catalog.matchups(rows.select(F.col("n_nationkey").alias("a"), F.col("c_mktsegment").alias("b"), "n_name", "c_mktsegment"), "a", "b", "n_name", "c_mktsegment")


@_query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 12")
def newest_n(spark, sf_dir):
    return planning.newest(_t(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), 12, F.desc("o_orderdate"), F.desc("o_orderkey")).select("o_orderkey")


@_query("""WITH RECURSIVE o AS (SELECT p_partkey, p_brand, CAST(p_size AS BIGINT) AS s, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS i FROM part),
r AS (SELECT p_brand, i, p_partkey, 0 AS bin, s AS total FROM o WHERE i = 1 UNION ALL
SELECT o.p_brand, o.i, o.p_partkey, CASE WHEN r.total > 0 AND r.total + o.s > 100 THEN r.bin + 1 ELSE r.bin END, CASE WHEN r.total > 0 AND r.total + o.s > 100 THEN o.s ELSE r.total + o.s END
FROM r JOIN o ON o.p_brand = r.p_brand AND o.i = r.i + 1)
SELECT p_brand, p_partkey, bin, printf('%s-%04d.tar', p_brand, bin + 3) AS shard FROM r""")
def pack_shards(spark, sf_dir):
    items = _t(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_size")
    return planning.shard_plan(items, "p_brand", ["p_partkey"], "p_size", 100, first=3).select("p_brand", "p_partkey", "bin", "shard")


@_query("""SELECT key, CAST(max(l) AS INTEGER) AS labels, CAST(max(d) AS INTEGER) AS documents FROM (SELECT doc_id AS key, 1 AS l, 0 AS d FROM labels WHERE doc_id % 3 <> 0
UNION ALL SELECT doc_id, 0, 1 FROM documents) GROUP BY key""")
def keyset_diff(spark, sf_dir):
    key = F.col("doc_id").alias("key")
    return catalog.key_sets(labels=_t(spark, sf_dir, "labels").where("doc_id % 3 != 0").select(key), documents=_t(spark, sf_dir, "documents").select(key))


@_query("SELECT c_custkey AS id, c_nationkey AS \"serverCharacter\" FROM customer")
def strip_identity(spark, sf_dir):
    rows = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("serverCharacter"), F.col("c_name").alias("serverUserNick"), F.col("c_name").alias("clientUserNick"))
    return planning.without_names(rows)


@_query("""WITH s AS (SELECT *, sum(l_quantity) OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS used FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey FROM s WHERE coalesce(used, 0) < 1000""")
def budget_cutoff(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem")
    return planning.within_budget(rows, "l_quantity", 1000, "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice").select("l_orderkey", "l_partkey", "l_suppkey")


@_query("""WITH o AS (SELECT o_orderpriority AS host, sum(o_orderkey % 1000) / 60 / 3600 AS hours, count(*) / 10.0 AS rate FROM orders GROUP BY 1)
SELECT sum(hours) AS hours, sum(rate) FILTER (WHERE host NOT LIKE '5%') AS rate, greatest(200.0 - sum(hours), 0) / sum(rate) FILTER (WHERE host NOT LIKE '5%') AS eta_hours FROM o""")
def fleet_eta(spark, sf_dir):
    hosts = _t(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("host")).agg(scalars.hours(F.sum(F.col("o_orderkey") % 1000)).alias("hours"), (F.count("*") / 10.0).alias("rate"))
    return catalog.fleet(hosts.withColumn("live", ~F.col("host").startswith("5")))


@_query("""WITH g AS (SELECT o_custkey, count(*) - 1 AS again FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS ok, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS fail, (SELECT count(*) FROM g) AS unique_ids,
(SELECT count(*) / 60 / 3600 FROM orders WHERE o_orderstatus = 'F') AS hours, (SELECT sum(o_orderkey % 777) / 1e9 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 4 <> 0) AS gb, CAST((SELECT sum(again) FROM g) AS BIGINT) AS n_dup, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 5 <> o_orderkey % 10) AS n_sync, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 50 = 0) AS n_mask,
(SELECT string_agg(o_custkey, ',' ORDER BY o_custkey) FROM (SELECT o_custkey FROM g WHERE again > 0 ORDER BY o_custkey LIMIT 5)) AS first_dups""")
def host_audit(spark, sf_dir):
    validation = F.struct((F.col("o_orderkey") % 5).alias("csv_rows"), (F.col("o_orderkey") % 10).alias("video_frames"), (F.col("o_orderkey") % 50 == 0).cast("int").alias("mask_mismatches"))
    attempts = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("replay_id"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed").alias("status"), F.lit(1).alias("frames"), F.col("o_orderkey").cast("string").alias("video"), validation.alias("validation"))
    sizes = _t(spark, sf_dir, "orders").where("o_orderkey % 4 != 0").select(F.col("o_orderkey").cast("string").alias("path"), (F.col("o_orderkey") % 777).alias("length"))
    return catalog.host_audit(attempts, sizes).select("ok", "fail", "hours", "gb", "unique_ids", "n_dup", "n_sync", "n_mask", F.array_join(F.transform("dup", lambda x: x.cast("string")), ",").alias("first_dups"))


@_query("""WITH a AS (SELECT o_orderpriority AS worker, sum(o_orderkey % 100) + max(o_orderkey % 7) AS b, sum(o_orderkey % 30) + max(o_orderkey % 900) AS a FROM orders GROUP BY 1)
SELECT worker, sum(b - a) / 10.0 AS fps FROM a GROUP BY ROLLUP (worker)""")
def sampled_rate(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "worker")
    # the counter of what is in flight has gone back between the two
    snapshot = lambda m, flying: o.groupBy("worker").agg(F.sum(F.col("o_orderkey") % m).alias("done"), F.max(F.col("o_orderkey") % flying).alias("in_flight"))
    return catalog.sampled_rate(snapshot(30, 900), snapshot(100, 7), 10.0)


@_query("""WITH f AS (SELECT o_orderpriority AS worker, o_orderkey % 1000 AS frames, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 777 END AS length FROM orders WHERE o_orderstatus = 'F')
SELECT worker, sum(frames) / 60 / 3600 AS hours, CAST(coalesce(sum(length), 0) AS BIGINT) AS video_bytes, coalesce(sum(length), 0) / 1e6 / (sum(frames) / 60 / 3600) AS mb_per_hour, CASE WHEN coalesce(sum(length), 0) / 1e6 / (sum(frames) / 60 / 3600) <= 700 THEN 'OK' ELSE 'OVER' END AS budget FROM f GROUP BY ROLLUP (worker)""")
def footage(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    attempts = o.select(F.col("o_orderpriority").alias("worker"), F.when(F.col("o_orderstatus") == "F", "ok").alias("status"), (F.col("o_orderkey") % 1000).alias("frames"), F.col("o_orderkey").cast("string").alias("video"))
    sizes = o.where("o_orderkey % 4 != 0").select(F.col("o_orderkey").cast("string").alias("path"), (F.col("o_orderkey") % 777).alias("length"))
    return catalog.footage(attempts, sizes).select("worker", "hours", "video_bytes", "mb_per_hour", "budget")


@_query("""SELECT source AS root, CAST(doc_id AS VARCHAR) AS rel FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def ship_delta(spark, sf_dir):
    docs, labels = _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    named = docs.select("doc_id", F.col("source").alias("root"), F.col("doc_id").cast("string").alias("rel"))
    return planning.not_shipped(named.drop("doc_id"), named.join(labels, "doc_id", "left_semi"))


@_query("""SELECT source AS root, count(*) AS captures, CAST(sum(doc_id % 100) AS BIGINT) AS total_frames, CAST(sum(n_chars) AS BIGINT) AS total_bytes FROM documents GROUP BY source""")
def captures_by_root(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select(F.col("source").alias("root"), (F.col("doc_id") % 100).alias("frames"), F.col("n_chars").alias("bytes"))
    return catalog.by_root(rows)


@_query("""SELECT o_orderkey AS replay_id FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0""")
def usable_captures(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    attempts = o.select(F.col("o_orderkey").alias("replay_id"), F.when(F.col("o_orderstatus") == "F", "ok").alias("status"), F.concat(F.lit("v"), "o_orderkey").alias("video"), F.concat(F.lit("c"), "o_orderkey").alias("csv"))
    files = o.where("o_orderkey % 3 != 0").select(F.concat(F.lit("v"), "o_orderkey").alias("path")).unionByName(o.where("o_orderkey % 5 != 0").select(F.concat(F.lit("c"), "o_orderkey").alias("path")))
    return planning.with_artefacts(attempts, files).select("replay_id")


@_query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber, l_extendedprice) AS rn FROM lineitem)
SELECT l_orderkey AS id, l_partkey, l_suppkey FROM r WHERE rn = 1 AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') AND NOT (l_returnflag = 'R') AND least(l_quantity, 25) >= 10""")
def listing_dedup(spark, sf_dir):
    line, seen = _t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"))
    first = planning.keep_first(line.withColumn("id", F.col("l_orderkey")), "id", "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice").join(seen, "id", "left_anti")
    flagged = first.select("id", "l_partkey", "l_suppkey", (F.col("l_returnflag") == "R").alias("mountainVaporBug"), F.lit(False).alias("unranked"), F.col("l_quantity").alias("serverUserElo"), F.lit(25.0).alias("clientUserElo"))
    return flagged.where(planning.unusable_reason(False, 10.0).isNull()).select("id", "l_partkey", "l_suppkey")


@_query("""SELECT p_partkey, coalesce(CAST(nullif(regexp_extract(p_brand, '([0-9]+)', 1), '') AS BIGINT), -1) AS number, concat('0x', upper(printf('%04x', p_size)), ',0x', upper(printf('%04x', p_size * 7))) AS deck,
CASE p_size % 22 WHEN 0 THEN 'Hakurei Shrine' WHEN 4 THEN 'Netherworld' WHEN 20 THEN 'Unknown(20)' ELSE 'other' END AS stage, regexp_replace(concat(p_brand, '-0a1b2c3d'), '-[^-]*$', '') AS stem,
printf('%s-%04d.tar', p_brand, p_size) AS shard, CAST(p_size AS INTEGER) AS shard_number, CASE WHEN p_size % 3 = 0 THEN 0 WHEN p_size % 9 = 7 THEN 7 ELSE 3 END AS mode, CASE WHEN p_size > 25 THEN 'e1; e2' END AS errors FROM part""")
def scalar_names(spark, sf_dir):
    size = F.col("p_size")
    stage = scalars.name_of(size % 22, STAGES)
    return _t(spark, sf_dir, "part").select(
        "p_partkey", scalars.first_number(F.col("p_brand")).alias("number"), scalars.deck_text(F.array(size, size * 7)).alias("deck"),
        F.when(stage.isin("Hakurei Shrine", "Netherworld", "Unknown(20)"), stage).otherwise("other").alias("stage"),
        scalars.stem_of_capture(F.concat("p_brand", F.lit("-0a1b2c3d"))).alias("stem"), scalars.shard_name(F.col("p_brand"), size).alias("shard"),
        scalars.shard_index(scalars.shard_name(F.col("p_brand"), size)).alias("shard_number"),
        scalars.replay_mode(F.when(size % 3 == 0, 0).when(size % 9 == 7, 7).otherwise(1)).alias("mode"),
        scalars.error_text(F.when(size > 25, F.array(F.lit("e1"), F.lit("e2"))).otherwise(F.array().cast("array<string>"))).alias("errors"),
    )


@_query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'timeout' ELSE 'failed' END WHEN o_orderkey % 3 = 1 THEN 'ok' ELSE 'failed' END AS status,
CASE WHEN o_orderkey % 3 = 1 THEN o_orderkey ELSE 0 END AS frames FROM orders""")
def run_status(spark, sf_dir):
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 1, F.concat(F.lit('{"status":"ok","frames":'), k.cast("string"), F.lit("}"))).when(k % 3 == 2, "{torn")
    runs = _t(spark, sf_dir, "orders").select("o_orderkey", text.alias("status_text"), F.when(k % 2 == 0, "timeout").otherwise("exit").alias("exit_reason"), F.lit(1).alias("exit_code"))
    return captures.run_status(runs).select("o_orderkey", "status", "frames")


@_query("""SELECT CAST(max(p_size) + 1 AS INTEGER) AS index FROM part WHERE p_brand = (SELECT min(p_brand) FROM part)""")
def next_shard(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    host = part.agg(F.min("p_brand")).first()[0]
    return planning.next_shard(part.select(scalars.shard_name(F.col("p_brand"), F.col("p_size")).alias("name")), host)


def _frame_texts(spark, sf_dir) -> DataFrame:
    """A frame table's text for each user: ticks from k, masks beyond range where k is 64 and more."""
    line = F.concat_ws(",", (F.col("i") - 1).cast("string"), F.col("k").cast("string"), (F.col("k") * 16).cast("string"), (F.col("event_id") % 3).cast("string"))
    rows = _events(spark, sf_dir).withColumn("i", F.expr("row_number() OVER (PARTITION BY user_id ORDER BY event_id)")).select("user_id", "i", line.alias("line"))
    texts = rows.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("i", "line"))).alias("rows"))
    body = F.array_join(F.transform("rows", lambda r: r["line"]), "\n")
    return texts.select(F.col("user_id").cast("string").alias("capture"), F.concat(F.lit("frame,game_frame,p1_input,p2_input\n"), body, F.lit("\n")).alias("value"))


@_query("""WITH {EVENTS}, l AS (SELECT *, lag(k) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events_k),
s AS (SELECT user_id, count(*) AS n, count(DISTINCT k) AS d, count(*) FILTER (WHERE k < p) AS dec, count(*) FILTER (WHERE k >= 64) AS wide, arg_min(k, event_id) AS k0, bool_or(k <> 0) AS a1, bool_or(event_id % 3 <> 0) AS a2 FROM l GROUP BY user_id)
SELECT CAST(user_id AS VARCHAR) AS capture, n AS csv_rows, d AS distinct_frames, n - d AS duplicate_rows, dec AS decreases, wide AS mask_range, CAST(0 AS BIGINT) AS mask_mismatches,
NOT (wide > 0 OR dec > 0 OR (n - d) * 10000 > n * 100 OR NOT (a1 OR a2)) AS ok,
concat_ws(',', CASE WHEN wide > 0 THEN 'csv.mask_range:error' END, CASE WHEN dec > 0 THEN 'csv.monotonic:error' END, CASE WHEN (n - d) * 10000 > n * 100 THEN 'csv.duplicates:error' WHEN n > d THEN 'csv.duplicates:warn' END,
CASE WHEN k0 <> 0 THEN 'csv.start:warn' END, CASE WHEN NOT a1 AND NOT a2 THEN 'csv.inputs:error' WHEN a1 <> a2 THEN 'csv.inputs:warn' END, CASE WHEN n < 600 THEN 'csv.length:warn' END) AS findings FROM s""")
def validation_report(spark, sf_dir):
    out = integrity.reports(captures.frames(_frame_texts(spark, sf_dir)))
    listed = F.array_join(F.transform("findings", lambda f: F.concat(f["check"], F.lit(":"), f["severity"])), ",")
    return out.select("capture", "csv_rows", "distinct_frames", "duplicate_rows", "decreases", "mask_range", "mask_mismatches", "ok", listed.alias("findings"))


@_query("""WITH {EVENTS} SELECT CAST(user_id AS VARCHAR) AS capture, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS BIGINT) AS frame, k AS game_frame, k * 16 AS p1_input, event_id % 3 AS p2_input,
CAST((k * 16 >> 4) & 1 AS INTEGER) AS p1_a, CAST((event_id % 3) & 1 AS INTEGER) AS p2_up FROM events_k""")
def frame_rewrite(spark, sf_dir):
    table = sinks.frame_table(captures.frames(_frame_texts(spark, sf_dir)))
    return table.select("capture", F.col("frame").cast("long").alias("frame"), "game_frame", "p1_input", "p2_input", "p1_a", "p2_up")


def _replay_bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for key in map(int, pdf["s_suppkey"]):
            n = key % 5000
            deck = struct.pack("<I3H", 3, 1, 2, 200 + n)
            head = struct.pack("<I4xBB6x", 210 + n, n % 22, n % 8) + deck
            second = struct.pack("<BB5x", (n + 1) % 22, 1) + deck + bytes([n % 20, n % 5]) + bytes(10)
            body = b"".join(struct.pack("<HH", (i * 7 + n) & 0x7FF, i % 4) for i in range(100 + n % 100))
            out.append((f"/corpus/{key}.rep", (head + second).ljust(0x80, b"\xff") + zlib.compress(body)))
        yield pd.DataFrame(out, columns=["path", "content"])


def _decoded(spark, sf_dir) -> DataFrame:
    return replays.decode(_dealt(spark, sf_dir, "supplier").select("s_suppkey").mapInPandas(_replay_bytes, "path string, content binary"))


@_query("""SELECT concat(s_suppkey, '.rep') AS file_name, CAST(210 + s_suppkey % 5000 AS BIGINT) AS game_version, CAST(s_suppkey % 5000 % 22 AS INTEGER) AS p1_character_id,
concat('0x0001,0x0002,0x', upper(printf('%04x', 200 + s_suppkey % 5000))) AS p1_deck_cards, CAST(s_suppkey % 5000 % 20 AS INTEGER) AS stage_id, CAST(100 + s_suppkey % 100 AS BIGINT) AS total_frames, CAST(NULL AS VARCHAR) AS parse_errors, 'zlib' AS strategy FROM supplier""")
def decode_replay(spark, sf_dir):
    return replay_tables.replay_dimension(_decoded(spark, sf_dir)).select("file_name", "game_version", "p1_character_id", "p1_deck_cards", "stage_id", "total_frames", "parse_errors", "strategy")


@_query("""SELECT concat(s_suppkey, '.rep') AS file_name, count(*) AS n_rows, CAST(sum((i * 7 + s_suppkey % 5000) & 1023) AS BIGINT) AS p1_sum, CAST(sum(((i * 7 + s_suppkey % 5000) >> 4) & 1) AS BIGINT) AS p1_a_rows, CAST(sum(i % 4) AS BIGINT) AS p2_sum
FROM supplier, range(200) AS t(i) WHERE i < 100 + s_suppkey % 100 GROUP BY 1""")
def decoded_frames(spark, sf_dir):
    decoded = _decoded(spark, sf_dir)
    names = replay_tables.replay_dimension(decoded).select("replay_id", "file_name")
    sums = replay_tables.frame_inputs(decoded).groupBy("replay_id").agg(F.count("*").alias("n_rows"), F.sum("p1_input").alias("p1_sum"), F.sum("p1_a").alias("p1_a_rows"), F.sum("p2_input").alias("p2_sum"))
    return sums.join(names, "replay_id").drop("replay_id")
