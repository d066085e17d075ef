"""Helpers shared by the corpus operators: tables, shared storage, labelled samples."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialize, shared_dir  # noqa: F401

#: Words are runs of anything but these ASCII white-space characters.
ASCII_SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; of those with texts and vectors, one that a scan would give to fewer tasks than there are cores is dealt out."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in ("documents", "pages", "embeddings") and rows.rdd.getNumPartitions() < cores:
        return rows.repartition(cores)
    return rows


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(mod))


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly over spark.sql.shuffle.partitions tasks: few bytes that become many rows are few bytes to a planner."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def join_to_groups(rows: DataFrame, groups: DataFrame, keys: list[str], copies: str, share: int = 1000) -> DataFrame:
    """Inner join of rows with groups, which has one row for each key and in copies how many of the rows have that key.

    Groups with more than 1/share of the rows are fewer than share, so these are broadcast and their rows
    stay where they are; only rows of smaller groups are shuffled by key. Runs a job that counts rows.
    """
    most = max(1, rows.count() // share)
    large = groups.where(F.col(copies) > most).drop(copies)
    small = rows.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(groups.where(F.col(copies) <= most).drop(copies), keys)
    return rows.join(F.broadcast(large), keys).unionByName(small)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held_out: int, per_class: int) -> DataFrame:
    """(doc_id, text, label) of at most per_class labelled rows of either class.

    Rows whose id_remainder is held_out are never taken. Rows are taken in the order of a hash of their
    id, so the choice is the same at every size and layout. A doc_id labelled both ways counts as 1;
    null labels and null ids take no part. The ids are few by the bound and are broadcast.
    """
    known = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & (id_remainder(F.col("doc_id"), mod) != held_out))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    order = (F.xxhash64(F.col("doc_id")), F.col("doc_id"))
    ids = known.where("label = 0").orderBy(*order).limit(per_class).unionByName(
        known.where("label = 1").orderBy(*order).limit(per_class)
    )
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "doc_id")


def class_counts(labels: DataFrame, label: str, mod: int, held_out: int) -> dict[int, int]:
    """Rows of each class outside the held-out fold."""
    known = labels.where(F.col(label).isin(0, 1) & (id_remainder(F.col("doc_id"), mod) != held_out))
    return {int(r[0]): int(r[1]) for r in known.groupBy(F.col(label).cast("int")).count().collect()}


def logistic_fit(x: np.ndarray, y: np.ndarray, priors: dict[int, int], l2: float = 1e-2) -> np.ndarray | None:
    """Newton's method for a logistic curve over few features; the last coefficient is the intercept.

    The two classes are weighted as priors has them. None if a class is missing.
    """
    if len(y) == 0 or y.min() == y.max():
        return None
    share = {k: priors.get(k, 1) / max(1, int((y == k).sum())) for k in (0, 1)}
    w = np.where(y == 1, share[1], share[0])
    w = w * len(y) / w.sum()
    a = np.column_stack([x, np.ones(len(y))])
    ridge = np.diag([l2] * x.shape[1] + [1e-6])
    beta = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (y - p)) - ridge @ beta
        hess = (a * (w * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ a + ridge
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 4.0 / max(1e-12, float(np.abs(step).max())))
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


_kept: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task. Workers outlive stages, so tasks of a stage without it call release."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def release() -> None:
    """Gives back what this worker kept for tasks of other stages."""
    if _kept:
        _kept.clear()
        trim()


@lru_cache(1)
def _malloc_trim() -> Callable | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):  # another C library
        return None


def trim() -> None:
    """Gives memory that this worker has freed back to the system; allocators keep tens of MB otherwise."""
    pa.default_memory_pool().release_unused()
    if give := _malloc_trim():
        give(0)


def slices(batch, rows: int = 256):
    """Parts of an Arrow batch, so that few texts are Python objects at a time; Spark itself bounds a batch's bytes."""
    pa.default_memory_pool().release_unused()  # what the batches before took
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2500) -> Iterator[None]:
    """For jobs that run inside: Arrow batches of so many rows at most. The session's own setting comes back after them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def slices_of(batch, column: str, most: int):
    """Parts of an Arrow batch of about so many bytes of the column at most, or of one row."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)
