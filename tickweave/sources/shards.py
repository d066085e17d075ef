"""Tar shards of captures, written by tasks and committed by the driver.

    spark.dataSource.register(TarShards)
    members.write.format("tar_shards").option("path", out).mode("append").save()

members (shard, n, root, rel, frames, file) has a row for each file of a capture, with all rows of a shard in one partition and
sorted by n and file (members_of lays them out so). A task writes a shard, its index and the list of what it holds
under temporary names; only when all tasks are done does the driver rename them, the list last. A task that fails
removes what it wrote and a job that fails leaves no shard and no state; a shard that is written again replaces itself.
Temporary names are in a folder of the job's own, which the driver makes before and removes after, so that tasks that were
stopped before they could clean up, or whose message was lost, leave nothing either.
"""

from __future__ import annotations

import hashlib
import json
import tarfile
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from . import files

MEMBERS = "shard string, n long, root string, rel string, frames long, file string"


@dataclass
class Written(WriterCommitMessage):
    """Temporary and final names, in the order in which they are renamed."""

    renames: list[tuple[str, str]]


class TarShards(DataSource):
    """Option: path, the folder of shards; it holds shards/, index/ and state/."""

    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def schema(self) -> str:
        return MEMBERS

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        writer = TarWriter(self.options["path"], uuid.uuid4().hex)
        writer.begin()
        return writer


class _Blocks:
    """What tarfile reads a member from."""

    def __init__(self, f):
        self.f = f

    def read(self, n: int) -> bytes:
        out = b""
        while len(out) < n and (more := self.f.read(n - len(out))):
            out += more
        return out


class TarWriter(DataSourceWriter):
    def __init__(self, root: str, job: str):
        self.root = root
        self.job = job

    def begin(self) -> None:
        """Makes the folder of temporary names; tasks don't, so one that goes on after the job's end has nowhere to write."""
        system, base = files.opened(self.root)
        system.create_dir(f"{base}/tmp/{self.job}", recursive=True)

    def _end(self) -> None:
        """Removes that folder; tasks that were told to stop may still be writing there."""
        system, base = files.opened(self.root)
        for _ in range(100):
            try:
                return system.delete_dir(f"{base}/tmp/{self.job}")
            except OSError:  # not empty, or not there any more
                if system.get_file_info(f"{base}/tmp/{self.job}").type.name == "NotFound":
                    return
                time.sleep(0.05)

    def _shard(self, system, base: str, shard: str, rows: list[Row] | Iterator[Row], made: list[tuple[str, str]]) -> None:
        """Writes one shard; the rows of a shard are not held, but for an entry for each capture."""
        attempt = uuid.uuid4().hex
        names = {kind: (f"{base}/tmp/{self.job}/{attempt}-{kind}", f"{base}/{kind}/{shard}{suffix}") for kind, suffix in (("shards", ""), ("index", ".json"), ("state", ".txt"))}
        made += names.values()
        entries: list[dict] = []
        with system.open_output_stream(names["shards"][0]) as out, tarfile.open(fileobj=out, mode="w|", format=tarfile.PAX_FORMAT) as tar:
            for r in rows:
                if not entries or (entries[-1]["root"], entries[-1]["rel"]) != (r["root"], r["rel"]):
                    entries.append({"root": r["root"], "rel": r["rel"], "frames": r["frames"]})
                source, path = files.opened(f"{r['root']}/{r['rel']}/{r['file']}")
                info = tarfile.TarInfo(f"{r['rel']}/{r['file']}")
                info.size = source.get_file_info(path).size
                with source.open_input_stream(path) as f:
                    tar.addfile(info, _Blocks(f))
        with system.open_output_stream(names["index"][0]) as out:
            out.write(json.dumps(entries).encode())
        with system.open_output_stream(names["state"][0]) as out:
            out.write("".join(f"{e['root']}::{e['rel']}\n" for e in entries).encode())

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        system, base = files.opened(self.root)
        made: list[tuple[str, str]] = []
        seen: set[str] = set()
        row = next(iterator, None)
        try:
            while row is not None:
                shard = row["shard"]
                if shard in seen:
                    raise ValueError(f"rows of {shard} are not together")
                seen.add(shard)
                after: list[Row] = []

                def of_shard(first=row, shard=shard, after=after) -> Iterator[Row]:
                    yield first
                    for r in iterator:
                        if r["shard"] != shard:
                            after.append(r)
                            return
                        yield r

                self._shard(system, base, shard, of_shard(), made)
                row = after[0] if after else None
        except BaseException:
            _remove(system, made)
            raise
        return Written(made)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, base = files.opened(self.root)
        renames = [x for m in messages if m is not None for x in m.renames]
        targets = [final for _, final in renames]
        if len(set(targets)) != len(targets):
            self._end()
            raise ValueError("a shard was written by two tasks")
        for kind in ("shards", "index", "state"):
            system.create_dir(f"{base}/{kind}", recursive=True)
            for temporary, final in renames:
                if final.startswith(f"{base}/{kind}/"):
                    system.move(temporary, final)
        self._end()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._end()


def _remove(system, names: list[tuple[str, str]]) -> None:
    for temporary, _ in names:
        try:
            system.delete_file(temporary)
        except OSError:
            pass


def members_of(plan: DataFrame, listing: DataFrame) -> DataFrame:
    """Rows for TarShards of a shard plan (shard, n, root, rel, frames) and the captures' files (root, rel, file).

    A shard holds what fits it by its plan's cap, and one task writes it.
    """
    rows = plan.select("shard", "n", "root", "rel", "frames").join(listing.select("root", "rel", "file"), ["root", "rel"])
    return rows.select("shard", "n", "root", "rel", "frames", "file").repartition("shard").sortWithinPartitions("shard", "n", "root", "rel", "file")


def contents(tars: DataFrame, path: str = "path") -> DataFrame:
    """shard, name, length and sha256 of every member of the tar files that the rows name, read by blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(path).to_pylist():
                system, name = files.opened(uri)
                rows = []
                with system.open_input_stream(name) as f, tarfile.open(fileobj=_Blocks(f), mode="r|") as tar:
                    for member in tar:
                        sha, data = hashlib.sha256(), tar.extractfile(member)
                        while block := data.read(files.BLOCK):
                            sha.update(block)
                        rows.append((name.rpartition("/")[2], member.name, member.size, sha.hexdigest()))
                columns = list(zip(*rows, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)], names=["shard", "name", "length", "sha256"])

    return tars.select(path).mapInArrow(run, "shard string, name string, length long, sha256 string")
