"""Counts of 64-bit keys over all of a corpus: sorted files of unique keys, memory-mapped where they are looked up.

Tasks count the keys of their partition with np.unique; the partial counts are written, sorted globally by a
range partitioning and summed run by run, so no task holds more than a batch of keys. Each range becomes a
pair of files (keys, counts) in the shared folder. A task maps the files and looks sorted keys up by
searchsorted; pages that it doesn't touch are never read, and the page cache is shared by all of a machine's workers.

The folder in spark.checkpoint.dir must be mounted as a file system on all machines. A file has a name of its
own for each attempt of a task and counts only if that attempt reports it, so lost executors and attempts that
ran twice leave no wrong counts.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

#: Keys that a task counts before it gives them on.
MOST_KEYS = 2_000_000


def mounted_dir(spark: SparkSession) -> str:
    """The shared folder as a path that every machine can open."""
    where = urlparse(common.shared_dir(spark))
    if where.scheme not in ("", "file"):
        raise ValueError("spark.checkpoint.dir must be a mounted folder (file:...): count shards are memory-mapped")
    return where.path


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unique keys in order and the sum of their counts."""
    if len(keys) == 0:
        return keys, counts
    order = np.argsort(keys, kind="stable")  # which merges runs that are in order
    keys, counts = keys[order], counts[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[start], np.add.reduceat(counts, start)


class PartialCounts:
    """Counts of the keys of a partition as arrays of them come; about most keys are held at a time."""

    def __init__(self, most: int = MOST_KEYS):
        self.most, self.fresh, self.size, self.kept = most, [], 0, 0

    def _merge(self) -> None:
        self.fresh = [summed(*(np.concatenate(x) for x in zip(*self.fresh, strict=True)))] if self.fresh else []
        self.size, self.kept = 0, len(self.fresh[0][0]) if self.fresh else 0

    def add(self, keys: np.ndarray, n: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Takes keys, with counts or as they stand; gives sorted unique keys and counts where more are held than may be."""
        self.fresh.append(np.unique(keys, return_counts=True) if n is None else (keys, n))
        self.size += len(self.fresh[-1][0])
        if self.size > max(self.most, self.kept):
            self._merge()
            if self.kept > self.most:
                yield from self.end()

    def end(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What is left."""
        self._merge()
        if self.kept:
            yield self.fresh[0]
        self.fresh, self.kept = [], 0


class CountShards:
    """Sorted files of keys and counts; can be sent to tasks."""

    def __init__(self, files: list[tuple[int, str]]):
        self.files = [f for _, f in sorted(files)]
        self.firsts = np.array(sorted(first for first, _ in files), dtype=np.int64)
        self._maps: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __getstate__(self):
        return {"files": self.files, "firsts": self.firsts, "_maps": {}}

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted keys, 0 for those that are nowhere."""
        out = np.zeros(len(keys), dtype=np.int64)
        if not self.files or not len(keys):
            return out
        cuts = np.searchsorted(keys, self.firsts)
        for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(keys)], strict=True)):
            if b > a:
                if i not in self._maps:
                    self._maps[i] = tuple(np.memmap(f"{self.files[i]}.{kind}", dtype="<i8", mode="r") for kind in ("keys", "counts"))
                held, n = self._maps[i]
                at = np.minimum(np.searchsorted(held, keys[a:b]), len(held) - 1)
                out[a:b] = np.where(held[at] == keys[a:b], n[at], 0)
        return out


def write_shards(partial: DataFrame, top_shift: int | None = None) -> tuple[CountShards, dict[int, int], int, int]:
    """Shards of the (key, n) rows; the largest count of each key >> top_shift; how many keys there are and the sum of all counts.

    The driver receives one row for each file and, with top_shift, one for each value of key >> top_shift and
    file: callers choose a shift that leaves a bounded number, such as a vocabulary.
    """
    folder = f"{mounted_dir(partial.sparkSession)}/tickweave-counts-{uuid.uuid4().hex}"
    os.makedirs(folder, exist_ok=True)
    partial = common.materialize(partial)  # its ranges are sampled, and then read

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/{uuid.uuid4().hex}"
        keys_file = counts_file = None
        key, n = np.empty(0, np.int64), np.empty(0, np.int64)
        first = last = None
        tops: dict[int, int] = {}
        size = total = 0

        def put(keys: np.ndarray, counts: np.ndarray) -> None:
            nonlocal keys_file, counts_file, first, last, size, total
            if keys_file is None:
                os.makedirs(folder, exist_ok=True)
                keys_file, counts_file, first = open(f"{name}.keys", "wb"), open(f"{name}.counts", "wb"), int(keys[0])
            keys_file.write(keys.astype("<i8").tobytes())
            counts_file.write(counts.astype("<i8").tobytes())
            size, total, last = size + len(keys), total + int(counts.sum()), int(keys[-1])
            if top_shift is not None:
                group = keys >> top_shift
                start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
                for g, most in zip(group[start].tolist(), np.maximum.reduceat(counts, start).tolist(), strict=True):
                    tops[g] = max(most, tops.get(g, 0))

        for batch in batches:
            keys = np.concatenate([key, batch.column("key").to_numpy(zero_copy_only=False)])
            counts = np.concatenate([n, batch.column("n").to_numpy(zero_copy_only=False)])
            if not len(keys):
                continue
            start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, counts = keys[start], np.add.reduceat(counts, start)
            key, n = keys[-1:], counts[-1:]  # the last run may go on in the next batch
            if len(keys) > 1:
                put(keys[:-1], counts[:-1])
        if len(key):
            put(key, n)
        if keys_file is not None:
            for f in (keys_file, counts_file):
                f.flush()
                os.fsync(f.fileno())
                f.close()
            rows = [(name, first, size, total), *((None, g, most, 0) for g, most in tops.items())]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["file", "key", "n", "total"])

    ranged = partial.repartitionByRange("key").sortWithinPartitions("key")
    made = ranged.mapInArrow(write, "file string, key long, n long, total long").collect()
    tops: dict[int, int] = {}
    for r in made:
        if r["file"] is None:
            tops[r["key"]] = max(r["n"], tops.get(r["key"], 0))
    files = [r for r in made if r["file"] is not None]
    return CountShards([(r["key"], r["file"]) for r in files]), tops, sum(r["n"] for r in files), sum(r["total"] for r in files)
