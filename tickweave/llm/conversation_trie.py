"""Prefix trie of rebuilt conversations, merged family by family first.

Conversations whose ids share c - c % 20 are a family, and its smallest id is its base. A conversation is rebuilt
as the first h turns of its base and its own turns after its first h. A node is a distinct sequence of first
turns; it is named by a hash of its parent's name and its last turn (128 bits of SHA-256), so equal prefixes of any two families have one name.

Families are brought together by one shuffle of turn digests, which leaves the texts where they are, and read in
order: only the base's first turns, the current node and the family's nodes so far are held, and a family of
very many nodes gives them on in parts. What is shuffled next are a family's combined nodes; partial sums by
name make them the trie's. A node's subtree is summed without walking the trie level by level: each node belongs to its
smallest member, the nodes of one conversation are the end of its path, and what they add up to is added to every
node of that path above them.

Rows without a conv_id take no part. Null turns come first; equal turns are in the order of role and
of the text's digest. Null roles and texts are empty. Repeated rows are turns of their own. An empty table has no nodes. Columns beside conv_id, turn, role
and text are not read. Ids below zero have the base that truncating division gives.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

FAMILY, MOST_SHARED = 20, 4
#: Nodes of a family that are held at a time, rows of an Arrow batch that is given on, and characters of ids hashed at a time.
MOST_NODES, OUT_ROWS, CHUNK = 200_000, 20_000, 60_000
ROOT = b""
_OUT = "kind int, node binary, parent binary, conv_id long, depth long, n long, words long, last boolean"
_PATH, _NODE = 0, 1


def shared_turns(conv_id: int) -> int:
    """How many turns a conversation has from its base."""
    return zlib.crc32(str(conv_id).encode()) % MOST_SHARED


def node_name(parent: bytes, digest: bytes) -> bytes:
    return hashlib.sha256(parent + digest).digest()[:16]


class _Rows:
    """Rows on their way out."""

    def __init__(self):
        self.rows: list[tuple] = []

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True))
        self.rows = []
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["kind", "node", "parent", "conv_id", "depth", "n", "words", "last"])


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of the rebuilt conversations and combined nodes of their families, of turns in order."""
    out = _Rows()
    nodes: dict[bytes, list] = {}  # name: parent, depth, members, smallest member, words
    base = conv = None
    head: list[tuple[bytes, int]] = []
    at, depth, words, skip, seen = ROOT, 0, 0, 0, 0
    parent: bytes | None = None

    def visit(last: bool) -> None:
        held = nodes.get(at)
        if held is None:
            nodes[at] = [parent, depth, 1, conv, words]
        else:
            held[2] += 1
            held[3] = min(held[3], conv)
        out.rows.append((_PATH, at, None, conv, depth, None, None, last))

    def step(digest: bytes, n: int) -> None:
        nonlocal at, parent, depth, words
        visit(False)
        parent, at, depth, words = at, node_name(at, digest), depth + 1, n

    def combined() -> None:
        out.rows.extend((_NODE, name, up, least, d, n, w, None) for name, (up, d, n, least, w) in nodes.items())
        nodes.clear()

    for batch in batches:
        for b, c, digest, n in zip(*(batch.column(k).to_pylist() for k in ("base", "conv_id", "digest", "words")), strict=True):
            if c != conv:
                if conv is not None:
                    visit(True)
                if b != base:
                    combined()
                    base, head = b, []
                conv, at, parent, depth, words, seen = c, ROOT, None, 0, 0, 0
                skip = shared_turns(c) if c != b else 0
                for d, w in head[:skip]:
                    step(d, w)
            if c == b and len(head) < MOST_SHARED - 1:
                head.append((digest, n))
            if seen >= skip:
                step(digest, n)
            seen += 1
            if len(nodes) > MOST_NODES:
                combined()
            if len(out.rows) > OUT_ROWS:
                yield out.batch()
    if conv is not None:
        visit(True)
        combined()
        yield out.batch()


def _end_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of each node's ends in chunks, of (node, conv_id) in order; a node of very many ends may lie in several ranges."""
    part = TaskContext.get().partitionId()
    rows: list[tuple] = []
    node, text, held, seq = None, [], 0, 0

    def flush() -> None:
        nonlocal text, held, seq
        if text:
            rows.append((node, part, seq, ",".join(text)))
        text, held, seq = [], 0, seq + 1

    def batch() -> pa.RecordBatch:
        nonlocal rows
        columns, rows = list(zip(*rows, strict=True)), []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int32(), pa.int64(), pa.string()), strict=True)], names=["node", "part", "seq", "ids"])

    for b in batches:
        for name, conv in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
            if name != node:
                flush()
                node, seq = name, 0
            text.append(str(conv))
            held += len(text[-1])
            if held > CHUNK:
                flush()
        if len(rows) > OUT_ROWS:
            yield batch()
    flush()
    if rows:
        yield batch()


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's joined ids, of their chunks in order."""
    node = sha = None
    for b in batches:
        names, digests = [], []
        for name, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if name != node:
                if node is not None:
                    names.append(node)
                    digests.append(sha.hexdigest())
                node, sha = name, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()], pa.string())], names=["node", "ends_sha256"])


def family_turns(conversations: DataFrame) -> DataFrame:
    """base, conv_id, digest and words of every turn, families together and in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))
    conv = F.col("conv_id").cast("long")
    rows = conversations.where("conv_id IS NOT NULL").select((conv - conv % FAMILY).alias("base"), conv.alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = ["base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    return rows.repartition("base").sortWithinPartitions(*order).select("base", "conv_id", "digest", "words")


def build(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes (node, parent, conv_id, depth, n_convs, words) and the paths (node, conv_id, depth, last) through it, both written."""
    with common.small_batches(conversations.sparkSession, OUT_ROWS):
        made = common.materialize(family_turns(conversations).mapInArrow(_families, _OUT))
    nodes = made.where(F.col("kind") == _NODE).groupBy("node").agg(
        F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n").alias("n_convs"), F.first("words").alias("words")
    )
    return common.materialize(nodes), made.where(F.col("kind") == _PATH).select("node", "conv_id", "depth", "last")


def end_digests(paths: DataFrame) -> DataFrame:
    """node and ends_sha256 of the nodes where conversations end.

    Ids are sorted by range, so a node where very many end is dealt over tasks; one task then reads its ids as chunks of text.
    """
    ends = common.materialize(paths.where("last").select("node", "conv_id"))
    texts = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(_end_texts, "node binary, part int, seq long, ids string")
    return texts.repartition("node").sortWithinPartitions("node", "part", "seq").mapInArrow(_end_digests, "node binary, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes with their children, leaves, tokens saved and ends; node and parent are their names."""
    nodes, paths = build(conversations)
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    stats = nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    stats = stats.withColumns({"own": (F.col("n_convs") - 1) * F.col("words"), "leaf": (F.col("n_children") == 0).cast("long")})
    up = Window.partitionBy("conv_id").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    stats = common.materialize(stats.withColumns({"own": F.sum("own").over(up), "leaf": F.sum("leaf").over(up)}))
    # what a conversation's own nodes add to those of its path above them
    sums = stats.groupBy("conv_id").agg(F.min("depth").alias("top"), F.max_by("own", -F.col("depth")).alias("own"), F.max_by("leaf", -F.col("depth")).alias("leaf"))
    added = paths.join(sums, "conv_id").where(F.col("depth") < F.col("top")).groupBy("node").agg(F.sum("own").alias("more_own"), F.sum("leaf").alias("more_leaves"))
    done = stats.join(added, "node", "left").join(end_digests(paths), "node", "left")
    done = done.select(
        "node", "parent", "conv_id", "depth", "n_convs", "n_children", (F.col("leaf") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("own") + F.coalesce("more_own", F.lit(0))).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
    # a parent of very many children is joined to them by broadcast
    named = stats.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    below = common.join_to_groups(nodes.where("parent IS NOT NULL").select("node", "parent"), named, ["parent"], "n_children")
    return done.join(below.select("node", "parent_conv_id"), "node", "left")


def op13_conversation_trie(spark, sf_dir: str) -> DataFrame:
    return trie(common.table(spark, sf_dir, "conversations")).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
