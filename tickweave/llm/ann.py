"""Approximate nearest neighbours by cross-polytope hashing.

A vector is turned by three rounds of random signs and a Hadamard transform and hashed to the nearest
signed axis. The key of a table is made of several such hashes, the last over fewer coordinates, so that
a table has about as many buckets as there are vectors and a query meets a falling share of them as they
grow. A query looks into the buckets, over all tables, that likely hold a near vector: probes of them,
a number that grows with the fifth root of the vectors. Keys and ids alone are shuffled; each distinct
candidate's vector is fetched once for a query and ranked exactly, by the cosine in double precision.

Rows with equal vectors are one candidate with its smallest ids (as many as a result can name), so a
vector that a third of the rows share is compared once; ties go to the smaller id. Buckets of more than
`few` vectors are not paired: they are split into blocks, which meet the queries in blocks too and give
each query's best alone. Null vectors, zero vectors and those with null or non-finite components take no
part, nor do rows with a null id; a null or false is_query is no query. A repeated (id, vector) row
counts once. With fewer candidates than k, all that are found are returned; an empty table gives no rows.
Only vec_id and embedding are read, so other columns clash with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths; the width is a power of 2."""
    y, h, d = x.copy(), 1, x.shape[1]
    while h < d:
        y = y.reshape(len(x), d // (2 * h), 2, h)
        y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2)
        h *= 2
    return y.reshape(len(x), d) / np.sqrt(d)


def rotate(x: np.ndarray, tables: int, seed: int) -> np.ndarray:
    """(tables, rows, width) pseudo-rotations of unit vectors, padded to a power of 2."""
    d = 1 << max(0, int(x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), d))
    padded[:, : x.shape[1]] = x
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(tables, 3, d))
    out = np.empty((tables, len(x), d))
    for t in range(tables):
        y = padded
        for s in signs[t]:
            y = hadamard(y * s)
        out[t] = y
    return out


@cache
def _largest(d: int) -> float:
    """How large the largest of d normal numbers is on average, signs aside."""
    return float(np.abs(np.random.default_rng(1).standard_normal((4096, d))).max(axis=1).mean())


class Hashes:
    """Keys of rows and the likeliest keys of queries, in tables of bits-bit buckets.

    near is the cosine for which probes are ordered: the chance that a vector at that cosine falls to an
    axis follows from the query's own coordinate there.
    """

    def __init__(self, width: int, bits: int, tables: int, seed: int, near: float = 0.45):
        self.width = 1 << max(0, int(width - 1).bit_length())
        self.bits, self.tables, self.seed, self.near = bits, tables, seed, near
        full = self.width.bit_length()  # bits of an axis and its sign
        self.dims = [self.width] * (bits // full) + ([1 << (bits % full - 1)] if bits % full else [])

    def _turned(self, x: np.ndarray, table: int) -> list[np.ndarray]:
        y = rotate(x, len(self.dims), self.seed * 100_003 + table)
        return [y[k][:, :d] for k, d in enumerate(self.dims)]

    def keys(self, x: np.ndarray) -> np.ndarray:
        """(tables, rows) keys of unit vectors."""
        out = np.empty((self.tables, len(x)), dtype=np.int64)
        for t in range(self.tables):
            key = np.full(len(x), t, dtype=np.int64)
            for y in self._turned(x, t):
                d, top = y.shape[1], np.abs(y).argmax(axis=1)
                key = key * (2 * d) + top + d * (y[np.arange(len(x)), top] < 0)
            out[t] = key
        return out

    def probes(self, x: np.ndarray, most: int) -> np.ndarray:
        """(rows, most or fewer) keys whose buckets a near vector of each row likeliest falls to."""
        c, n = self.near, np.arange(len(x))[:, None]
        keys, chances = [], []
        for t in range(self.tables):
            key, chance = np.full((len(x), 1), t, dtype=np.int64), np.zeros((len(x), 1))
            for y in self._turned(x, t):
                d = y.shape[1]
                sides = np.concatenate([y, -y], axis=1) * math.sqrt(self.width)
                each = -((_largest(d) - c * sides) ** 2) / (2 * (1 - c * c))
                each -= np.log(np.exp(each).sum(axis=1, keepdims=True))
                order = np.argsort(-each, axis=1, kind="stable")[:, :most]
                by_chance = np.argsort(-chance, axis=1, kind="stable")
                key, chance = key[n, by_chance], chance[n, by_chance]
                # of two falling lists the best sums are among the places (i, j) with (i + 1)(j + 1) <= most
                i, j = np.divmod(np.arange(key.shape[1] * order.shape[1]), order.shape[1])
                i, j = (a[(i + 1) * (j + 1) <= most] for a in (i, j))
                key, chance = key[:, i] * (2 * d) + order[:, j], chance[:, i] + each[n, order[:, j]]
                if key.shape[1] > most:
                    best = np.argpartition(-chance, most, axis=1)[:, :most]
                    key, chance = key[n, best], chance[n, best]
            keys.append(key)
            chances.append(chance)
        key, chance = np.concatenate(keys, axis=1), np.concatenate(chances, axis=1)
        best = np.argsort(-chance, axis=1, kind="stable")[:, :most]
        return key[n, best]


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow column of equally long lists of numbers, as doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """By powers of two, which are exact, so that squares neither vanish nor overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = _scaled(x)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def usable(v: Column) -> Column:
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & good & F.exists(v, lambda c: c != 0)


def _cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Of one query with each row, both scaled; summed alike whichever rows stand beside."""
    return np.einsum("j,ij->i", q, v) / (np.sqrt(np.einsum("j,j->", q, q)) * np.sqrt(np.einsum("ij,ij->i", v, v)))


def _best(reps: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Places of the most best scores; those that tie go by the smaller rep."""
    if len(score) > 4 * most:
        edge = -np.partition(-score, most)[most]
        kept = np.flatnonzero(score >= edge)
    else:
        kept = np.arange(len(score))
    return kept[np.lexsort((reps[kept], -score[kept]))[:most]]


_FOUND = "query long, rep long, score double"


def _rank_candidates(most: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """One query row (query, q) and its candidates (query, rep, v)."""
        if not left.num_rows or not right.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "rep": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        reps, score = right.column("rep").to_numpy(), _cosines(_scaled(_matrix(left.column("q")))[0], _scaled(_matrix(right.column("v"))))
        at = _best(reps, score, most)
        return pa.table({"query": pa.array([left.column("query")[0].as_py()] * len(at), pa.int64()), "rep": reps[at], "score": score[at]})

    return run


def _rank_blocks(most: int):
    def run(cell: pa.Table) -> pa.Table:
        """A block of a large bucket and a block of the queries that look into it."""
        asks = cell.column("asks").to_numpy(zero_copy_only=False)
        ids, x = cell.column("id").to_numpy(), _scaled(_matrix(cell.column("v")))
        reps, rows, out = ids[~asks], x[~asks], []
        for query, q in zip(ids[asks], x[asks], strict=True):
            score = _cosines(q, rows)
            at = _best(reps, score, most)
            out.append((np.full(len(at), query), reps[at], score[at]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out and len(rows) else [np.array([], "int64"), np.array([], "int64"), np.array([], "float64")]
        return pa.table(dict(zip(("query", "rep", "score"), columns, strict=True)))

    return run


def size_of_index(n: int) -> tuple[int, int]:
    """Bits of a bucket's key and probes of a query for n different vectors; of up to seven, all buckets of 64 tables."""
    return max(1, n.bit_length() - 2), max(128, math.ceil(70 * n ** (1 / 5)))


def candidates(classes: DataFrame, asking: DataFrame, n: int, width: int, tables: int = 64, few: int = 256, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """Pairs (query, rep) that share a bucket of at most few vectors, each once; and (key, query, n) of larger ones, with the index (key, rep)."""
    bits, probes = size_of_index(n)
    hashes = Hashes(width, bits, tables, seed)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, 1024):
                keys = hashes.keys(_unit(_matrix(part.column("v"))))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.tile(part.column("rep").to_numpy(), tables))], names=["key", "rep"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, 32):
                keys = hashes.probes(_unit(_matrix(part.column("q"))), probes)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(part.column("query").to_numpy(), keys.shape[1]))], names=["key", "query"])

    indexed = common.materialize(common.spread(classes.select("rep", "v")).mapInArrow(index, "key long, rep long"))
    asked = common.spread(asking.select("query", "q")).mapInArrow(probe, "key long, query long")
    sizes = indexed.groupBy("key").agg(F.count("*").alias("n"))
    asked = common.materialize(asked.join(sizes, "key"))
    pairs = asked.where(F.col("n") <= few).join(indexed, "key").select("query", "rep").distinct()
    return pairs, asked.where(F.col("n") > few), indexed


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, tables: int = 64, few: int = 256, block: int = 4096, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row of (vec_id, embedding).

    Vectors that are not as long as most, or of two lengths that are equally frequent as the longer, take no part. tables trades work for recall; few and block bound what a task
    holds of a query and of a bucket. Runs jobs that write the index.
    """
    # floats stay floats until they are multiplied: half the bytes to move
    kind = "array<float>" if "float" in vectors.schema["embedding"].dataType.simpleString() else "array<double>"
    rows = vectors.select("vec_id", F.col("embedding").cast(kind).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).dropDuplicates(["vec_id", "v"])
    lengths = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n"))
    usual = lengths.agg(F.max_by("size", F.struct("n", "size"))).first()[0]
    rows = rows.where(F.size("v") == (usual or 0))
    by_vector = Window.partitionBy("v")
    # row_number() <= k + 1 is cut before the shuffle too, so a hot vector sends few rows of each task.
    classes = (
        rows.withColumn("n", F.row_number().over(by_vector.orderBy("vec_id")))
        .where(F.col("n") <= k + 1)
        .groupBy("v")
        .agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    classes = common.materialize(classes.select("rep", "v", "ids"))
    queries = rows.where("is_query").select(F.col("vec_id").alias("query_id"), "v")
    asking = queries.groupBy("v").agg(F.count("*").alias("copies")).join(classes.select("v", "rep"), "v")
    asking = common.materialize(asking.select(F.col("rep").alias("query"), F.col("v").alias("q"), "copies"))
    n = classes.count()
    pairs, large, indexed = candidates(classes, asking, n, usual or 1, tables, few, seed)

    # a query's own vector is a candidate, as other rows may share it
    pairs = pairs.unionByName(asking.select("query", F.col("query").alias("rep"))).distinct()
    fetched = pairs.join(classes.select("rep", "v"), "rep")
    found = asking.select("query", "q").groupBy("query").cogroup(fetched.groupBy("query")).applyInArrow(_rank_candidates(k + 1), _FOUND)

    parts = large.groupBy("key").agg(F.max("n").alias("n"), F.count("*").alias("asks"))
    parts = parts.select("key", F.ceil(F.col("n") / block).cast("int").alias("of_rows"), F.ceil(F.col("asks") / block).cast("int").alias("of_asks"))
    dealt = lambda id_, count: F.pmod(F.xxhash64(id_), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    own = indexed.join(parts, "key").select("key", "rep", dealt("rep", "of_rows").alias("r"), every("of_asks").alias("a")).join(classes.select("rep", "v"), "rep")
    ask = large.select("key", "query").join(parts, "key").select("key", "query", dealt("query", "of_asks").alias("a"), every("of_rows").alias("r")).join(asking.select("query", "q"), "query")
    cells = own.select("key", "r", "a", F.col("rep").alias("id"), "v", F.lit(False).alias("asks")).unionByName(ask.select("key", "r", "a", F.col("query").alias("id"), F.col("q").alias("v"), F.lit(True).alias("asks")))
    in_large = cells.groupBy("key", "r", "a").applyInArrow(_rank_blocks(k + 1), _FOUND)

    # a pair may be found in several large buckets
    found = found.unionByName(in_large).groupBy("query", "rep").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    named = found.join(classes.select("rep", "ids"), "rep").select("query", F.explode("ids").alias("vec_id"), "score")
    # at most (k + 1) x (k + 1) ids for each query vector
    lists = named.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))).alias("all")).join(asking, "query")
    lists = common.materialize(lists.select(F.col("q").alias("v"), "copies", "all"))
    answers = common.join_to_groups(queries, lists, ["v"], "copies")
    top = F.slice(F.filter("all", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranked = answers.select("query_id", F.posexplode(top).alias("n", "x"))
    return ranked.select("query_id", (F.col("n") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.less")).alias("score"))


def op4_cross_polytope_ann(spark, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    return nearest(vectors, F.col("vec_id") % 50 == 0)
