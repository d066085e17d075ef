"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word shingles. If the 64 bits are
cut into blocks, two fingerprints at most `bits` bits apart agree in all but `bits` of the blocks; so
every choice of (blocks - bits) blocks is a table whose keys such pairs share in at least one. Equal
fingerprints are one node, so copies are never paired. Keys that few fingerprints share are joined with
themselves; a key that many share is cut into chunks, every two chunks are compared in one task of
bounded size, and only edges of a spanning forest leave it. Components come from repeated large-star
and small-star steps, each written to the shared folder.

Texts that are null, empty or without a word have the fingerprint zero and are linked like any other.
Repeated rows have the same fingerprint and component; a null doc_id takes part but names no component
(a component of null ids alone is null). Very long texts are hashed whole, in parts of their shingles;
an empty table gives no rows. Columns beside doc_id and text are carried along only by
drop_near_duplicates, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

def words_of(text: str) -> list[bytes]:
    """Runs of anything but ASCII white space, with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "replace").lower().split()  # of bytes, both go by ASCII alone


def _majority(h: np.ndarray) -> int:
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 65536):
        part = h[i : i + 65536].byteswap().view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(h)).tobytes(), "big")


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64, seed 42, of each width-word shingle, repeats included; of fewer words of the whole sequence."""
    w = words_of(text or "")
    if len(w) <= width:
        shingles = [b" ".join(w)] if w else []
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, 42) for s in shingles], dtype=np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of the shingles' hashes; 0 without words."""
    return _majority(shingle_hashes(text, width))


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                made = [_majority(shingle_hashes(t, width)) for t in part.column("text").to_pylist()]
                longs = pa.array(np.array(made, dtype=np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), longs], names=["doc_id", "fp"])

    kept = docs.select("doc_id", "text")
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, fp long")


Masks = list[tuple[int, int]]


def block_masks(bits: int, blocks: int) -> Masks:
    """Masks of fp for every choice of blocks - bits of the blocks that it is cut into; none of x."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [(sum(c), 0) for c in itertools.combinations(one, blocks - bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _distance(a: str, b: str) -> Column:
    return F.expr(f"bit_count({a}.fp ^ {b}.fp) + bit_count({a}.x ^ {b}.x)")


def _forest(limit: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("id").sort_values("id")
        ids, fps, xs = pdf["id"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64), pdf["x"].to_numpy().view(np.uint64)
        root = np.arange(len(ids))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        edges = []
        for i in range(len(ids)):
            apart = np.bitwise_count(fps[i + 1 :] ^ fps[i]) + np.bitwise_count(xs[i + 1 :] ^ xs[i])
            near = i + 1 + np.flatnonzero(apart <= limit)
            if len(near) == 0:
                continue
            a = find(i)
            for j in near[root[near] != a]:
                b = find(int(j))
                if a != b:
                    root[b] = a
                    edges.append((i, int(j)))
        e = np.array(edges, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": ids[e[:, 0]], "b": ids[e[:, 1]]})

    return run


def links(nodes: DataFrame, tables: Masks, limit: int, few: int = 8, chunk: int = 4096) -> DataFrame:
    """(a, b) edges between the ids of nodes (id, fp, x) whose closure is that of all linked pairs.

    Pairs are linked if their fp and x agree under one of the masks and differ in limit bits or fewer. Keys
    that the same nodes share count once. few: the most nodes of a key that are joined in pairs; chunk: the
    nodes of a part of a key with more. Every edge is verified. Work within a hot key grows with its
    square, spread over tasks of 2 x chunk rows; rows that leave a task are at most their number.
    """
    masks = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).alias("m"), F.lit(_signed(n)).alias("n")) for t, (m, n) in enumerate(tables)))
    keyed = common.spread(nodes).select("id", "fp", "x", F.explode(masks).alias("k"))
    keyed = keyed.select("id", F.xxhash64("k.t", F.col("fp").bitwiseAND(F.col("k.m")), F.col("x").bitwiseAND(F.col("k.n"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = common.materialize(keyed.join(shared, "key", "left_semi"))
    marks = [F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"), F.bit_xor(F.xxhash64("id")).alias("h"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("g")]
    sets = common.materialize(members.groupBy("key").agg(*marks).groupBy("n", "a", "b", "h", "g").agg(F.min("key").alias("key")).drop("h", "g"))
    full = members.join(sets.where("n > 2").select("key", "n"), "key").join(nodes, "id")
    small = full.where(F.col("n") <= few)
    pairs = small.alias("l").join(small.alias("r"), F.expr("l.key = r.key AND l.id < r.id") & (_distance("l", "r") <= limit)).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))
    left, right = (nodes.select(F.col("id").alias(c), F.struct("fp", "x").alias(s)) for c, s in (("a", "l"), ("b", "r")))
    twos = sets.where("n = 2").select("a", "b").join(left, "a").join(right, "b").where(_distance("l", "r") <= limit).select("a", "b")
    parts = F.ceil(F.col("n") / chunk).cast("int")
    large = full.where(F.col("n") > few).withColumn("parts", parts).withColumn("c", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    large = large.withColumn("lo", F.least("c", "other")).withColumn("hi", F.greatest("c", "other"))
    forest = large.groupBy("key", "lo", "hi").applyInPandas(_forest(limit), "a long, b long")
    return twos.unionByName(pairs).unionByName(forest).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the (a, b) edges; the root is the smallest node that it reaches.

    Large-star then small-star until nothing changes; edges and marks are written out each round. A node
    with many neighbours is only ever aggregated (min) and joined, never gathered.
    """
    now = common.materialize(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    stamp, n_edges = None, now.count()
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        now = common.materialize(small.where("u > v").distinct(), n_edges)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == stamp:
            break
        stamp, n_edges = mark, mark[0]
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, width: int = 3, bits: int = 3, blocks: int = 6) -> DataFrame:
    """doc_id, fp and component_id of every row of docs."""
    fps = common.materialize(fingerprints(docs, width))
    nodes = common.materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")))
    roots = components(links(nodes.select(F.col("fp").alias("id"), "fp", F.lit(0).cast("long").alias("x")), block_masks(bits, blocks), bits))
    grouped = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first_id", "copies", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = common.materialize(grouped.join(least, "root").select("fp", "copies", "component_id"))
    return common.join_to_groups(fps, by_fp, ["fp"], "copies").select("doc_id", "fp", "component_id")


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _rows(docs: DataFrame) -> DataFrame:
    """doc, row (a hash of the text) and text: rows that repeat a doc_id with another text have names of their own."""
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("row"), "text")


def _sketches(rows: DataFrame, width: int, bands: int, band: int) -> DataFrame:
    """doc, row, n (distinct shingles), s and t, which name their set, a hashed key of each band, sig, a byte of each min-hash, and fp, the fingerprint as op7 has it."""
    rng = np.random.default_rng(7)
    times = rng.integers(0, 1 << 63, bands * band, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 1 << 63, bands * band, dtype=np.uint64)

    def one(text: str | None) -> tuple:
        h = np.unique(shingle_hashes(text, width))
        least = np.full(bands * band, (1 << 64) - 1, dtype=np.uint64)
        for i in range(0, len(h), 2048):
            least = np.minimum(least, (h[i : i + 2048, None] * times + plus).min(axis=0))
        raw, whole = least.tobytes(), h.tobytes()
        keys = [xxhash.xxh64_intdigest(raw[8 * band * k : 8 * band * (k + 1)], k) for k in range(bands)]
        sig = (least >> np.uint64(56) ^ least >> np.uint64(8)).astype(np.uint8).tobytes()
        return len(h), xxhash.xxh64_intdigest(whole, 1), xxhash.xxh64_intdigest(whole, 2), keys, sig, fingerprint(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        for batch in batches:
            for part in common.slices(batch):
                n, s, t, keys, sig, fp = zip(*map(one, part.column("text").to_pylist()), strict=True) if part.num_rows else ((),) * 6
                longs = [pa.array(np.array(x, dtype=np.uint64).reshape(-1).view(np.int64)) for x in (s, t, keys, fp)]
                listed = pa.ListArray.from_arrays(np.arange(part.num_rows + 1, dtype=np.int32) * bands, longs[2])
                arrays = [part.column("doc"), part.column("row"), pa.array(n, pa.int32()), longs[0], longs[1], listed, pa.array(sig, pa.binary()), longs[3]]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc", "row", "n", "s", "t", "keys", "sig", "fp"])

    return rows.mapInArrow(run, "doc long, row long, n int, s long, t long, keys array<long>, sig binary, fp long")


def _shingle_sets(rows: DataFrame, width: int) -> DataFrame:
    """doc, row and the distinct shingles' hashes of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        for batch in batches:
            for part in common.slices(batch):
                sets = [np.unique(shingle_hashes(t, width)).view(np.int64) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("row"), pa.array(sets, pa.list_(pa.int64()))], names=["doc", "row", "shingles"])

    return rows.mapInArrow(run, "doc long, row long, shingles array<long>")


def _sketch_pairs(similarity: float, away: float):
    """Pairs of a hot key to be verified, from the min-hashes' agreement, of nodes that aren't known to be of one component (of).

    Nodes that agree clearly are joined by a forest; of less clear pairs those that it leaves apart.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["doc", "row"]).sort_values(["doc", "row"])
        docs, rows, n = pdf["doc"].to_numpy(), pdf["row"].to_numpy(), pdf["n"].to_numpy()
        sigs = np.frombuffer(b"".join(pdf["sig"]), dtype=np.uint8).reshape(len(pdf), -1)
        label, edges, unclear = pdf.groupby(["of_doc", "of_row"]).ngroup().to_numpy().copy(), [], []
        for i in range(len(pdf)):
            apart = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
            apart = apart[np.minimum(n[apart], n[i]) >= similarity * np.maximum(n[apart], n[i])]
            agree = (sigs[apart] == sigs[i]).mean(axis=1)
            for j in apart[agree >= similarity + away]:
                if label[j] != label[i]:
                    label[label == label[j]] = label[i]
                    edges.append((i, int(j)))
            less = apart[(agree >= similarity - away) & (agree < similarity + away)].astype(np.int32)
            unclear.append(np.column_stack([np.full_like(less, i), less]))
        left = np.concatenate([np.zeros((0, 2), np.int32), *unclear])
        e = np.concatenate([np.array(edges, dtype=np.int32).reshape(-1, 2), left[label[left[:, 0]] != label[left[:, 1]]]])
        return pd.DataFrame({"a_doc": docs[e[:, 0]], "a_row": rows[e[:, 0]], "b_doc": docs[e[:, 1]], "b_row": rows[e[:, 1]]})

    return run


def shared_bands(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, c, id) of the nodes (id, keys) that share a key with others, c of them, and (a, b) of the keys of two. Keys that the same nodes share are one."""
    members = common.spread(nodes.select("id", "keys")).select("id", F.explode(F.array_distinct("keys")).alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    members = common.materialize(members.join(shared, "key", "left_semi"))
    marks = [F.count("*").alias("c"), F.min("id").alias("a"), F.max("id").alias("b"), F.bit_xor(F.xxhash64("id")).alias("h"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("g")]
    sets = common.materialize(members.groupBy("key").agg(*marks).groupBy("c", "a", "b", "h", "g").agg(F.min("key").alias("key")).drop("h", "g"))
    return members.join(sets.where("c > 2").select("key", "c"), "key").select("key", "c", "id"), sets.where("c = 2").select("a", "b")


def fingerprint_pairs(printed: DataFrame, bits: int = 3, blocks: int = 6) -> DataFrame:
    """(a, b) ids of rows (id, fp) by SimHash: each id with the smallest one of its fingerprint, and these of fingerprints that op7's links join."""
    first = common.materialize(printed.groupBy("fp").agg(F.min("id").alias("a")))
    near = links(first.select(F.col("fp").alias("id"), "fp", F.lit(0).cast("long").alias("x")), block_masks(bits, blocks), bits)
    ends = [first.select(F.col("fp").alias(c), F.col("a").alias(f"id_{c}")) for c in ("a", "b")]
    linked = near.join(ends[0], "a").join(ends[1], "b").select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))
    return printed.join(first, "fp").select("a", F.col("id").alias("b")).unionByName(linked).where("a != b").distinct()


def similar_components(nodes: DataFrame, similarity: float, verified, few: int = 8, chunk: int = 2048, candidates: DataFrame | None = None) -> DataFrame:
    """(node, root) of nodes (id, n, keys, sig) that are candidates (a, b) or share bands and whose pairs are found similar by verified((a, b) pairs).

    Of a key that few nodes share all pairs are verified, of a key of more each node's with the smallest one: copies of one text are a component after
    that. Nodes of such a key that are then still in different components, and only these, are compared with each other: their pairs are thinned
    by their min-hashes (four standard errors of the share that agrees) in parts of chunk nodes, and verified too.
    """
    full, twos = shared_bands(nodes)
    full = common.materialize(full)
    sizes = nodes.select("id", "n")

    def possible(pairs: DataFrame) -> DataFrame:
        for c in ("a", "b"):
            pairs = pairs.join(sizes.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}")), c)
        return pairs.where(F.least("n_a", "n_b") >= F.lit(similarity) * F.greatest("n_a", "n_b")).select("a", "b")

    small, large = full.where(F.col("c") <= few), full.where(F.col("c") > few)
    pairs = small.alias("l").join(small.alias("r"), F.expr("l.key = r.key AND l.id < r.id")).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))
    led = large.join(large.groupBy("key").agg(F.min("id").alias("a")), "key").where("id != a").select("a", F.col("id").alias("b"))
    edges = common.materialize(verified(possible(pairs.unionByName(led).unionByName(twos if candidates is None else twos.unionByName(candidates)).distinct())))
    roots = components(edges)

    of = roots.select(F.col("node").alias("id"), "root")
    told = common.materialize(large.join(of, "id", "left").select("key", "c", "id", F.coalesce("root", "id").alias("of")))
    apart = told.groupBy("key").agg(F.min("of").alias("lo"), F.max("of").alias("hi")).where("lo != hi").select("key")
    left = told.join(apart, "key", "left_semi").join(nodes.select("id", "n", "sig"), "id")
    left = left.withColumn("parts", F.ceil(F.col("c") / chunk).cast("int")).withColumn("p", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    left = left.select("key", F.least("p", "other").alias("lo"), F.greatest("p", "other").alias("hi"), "id.doc", "id.row", "n", "sig", F.col("of.doc").alias("of_doc"), F.col("of.row").alias("of_row"))
    hot = left.groupBy("key", "lo", "hi").applyInPandas(_sketch_pairs(similarity, 0.13), "a_doc long, a_row long, b_doc long, b_row long")
    hot = common.materialize(hot.select(*(F.struct(F.col(f"{c}_doc").alias("doc"), F.col(f"{c}_row").alias("row")).alias(c) for c in ("a", "b"))).distinct())
    return roots if hot.isEmpty() else components(edges.unionByName(verified(hot)))


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str, width: int = 5, similarity: float = 0.8, bands: int = 24, band: int = 6) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id, one if rows repeat it; with all columns.

    Texts are linked if the sets of their five-word shingles have a Jaccard similarity of `similarity` or
    more. Candidates come from SimHash fingerprints, linked as in near_duplicates, and, as these miss many pairs at 0.8,
    also from min-hashes: they share all those of one of the bands, which a pair at 0.8 does with a probability of
    0.9993, at 0.85 and more of 0.99999. Each of both is verified on the whole sets of both texts. Equal sets are
    one node, named by the doc_id and text hash of its first row, so a doc_id repeated with another text
    is a row like any other. Rows with a null doc_id can't be named as the one of a group, and stay.
    """
    rows = _rows(docs.where(F.col("doc_id").isNotNull()))
    with common.small_batches(spark):
        sketches = common.materialize(_sketches(rows, width, bands, band))
    named = F.min(F.struct("doc", "row")).alias("id")
    named_nodes = common.materialize(sketches.groupBy("s", "t").agg(named, *(F.first(c).alias(c) for c in ("n", "keys", "sig"))))
    nodes = named_nodes.drop("s", "t")
    # rows of one set of five-word shingles can differ in their fingerprints
    printed = sketches.select("s", "t", "fp").distinct().join(named_nodes.select("s", "t", "id"), ["s", "t"]).select("id", "fp")
    candidates = fingerprint_pairs(common.materialize(printed))

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = common.materialize(pairs)
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).select("id.*").distinct()
        sets = _shingle_sets(rows.join(ids, ["doc", "row"], "left_semi").dropDuplicates(["doc", "row"]), width)
        with common.small_batches(spark):
            sets = common.materialize(sets.select(F.struct("doc", "row").alias("id"), "shingles"))
        for c in ("a", "b"):
            pairs = pairs.join(sets.select(F.col("id").alias(c), F.col("shingles").alias(f"of_{c}")), c)
        both = F.size(F.array_intersect("of_a", "of_b"))
        return pairs.where(both >= F.lit(similarity) * (F.size("of_a") + F.size("of_b") - both)).select("a", "b")

    roots = similar_components(nodes, similarity, verified, candidates=candidates)
    # a component's root is its smallest id; of all other nodes the first row is their smallest
    first = nodes.select("id").join(roots.where("node != root").select(F.col("node").alias("id")), "id", "left_anti").select(F.col("id.doc").alias("__doc"), F.col("id.row").alias("__row"))
    keyed = docs.withColumn("__doc", F.col("doc_id").cast("long")).withColumn("__row", F.xxhash64("text"))
    # repeated rows become one before they are shuffled
    kept = keyed.where(F.col("doc_id").isNotNull()).dropDuplicates(["__doc", "__row"]).join(first, ["__doc", "__row"], "left_semi").select(*docs.columns)
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
