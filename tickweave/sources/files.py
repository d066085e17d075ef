"""Files by URI, on any file system that the workers reach, read and written by blocks."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes that are held of a file at a time.
BLOCK = 1 << 20


def opened(uri: str):
    """The file system of a URI or path, and the path on it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + unquote(uri[5:]).lstrip("/")
    return (fs.LocalFileSystem(), uri) if "://" not in uri else fs.FileSystem.from_uri(uri)


def blocks(uri: str, size: int = BLOCK) -> Iterator[bytes]:
    system, path = opened(uri)
    with system.open_input_stream(path) as f:
        while block := f.read(size):
            yield block


def digest(uri: str, size: int = BLOCK) -> tuple[int | None, str | None]:
    """Length and SHA-256 of a file, nulls if it isn't there."""
    sha, length = hashlib.sha256(), 0
    try:
        for block in blocks(uri, size):
            sha.update(block)
            length += len(block)
    except FileNotFoundError:
        return None, None
    return length, sha.hexdigest()


def file_digests(files: DataFrame, path: str = "path") -> DataFrame:
    """The rows with length and sha256 of the file that each names, null where there is none.

    Tasks read the files by blocks, so a file may be larger than a row or a worker's memory; its size is what one
    task reads, and small and large files are dealt out alike by the rows' partitioning.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [digest(p) if p is not None else (None, None) for p in batch.column(path).to_pylist()]
            columns = [*batch.columns, pa.array([n for n, _ in found], pa.int64()), pa.array([d for _, d in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "length", "sha256"])

    return files.mapInArrow(run, type(files.schema)([*files.schema.fields]).add("length", "long").add("sha256", "string"))


def write_lines(lines: DataFrame, folder: str, header: str) -> None:
    """Writes rows (path below the folder, value) as a text of lines for each path, with a header; the folder is replaced when all are there.

    Rows of a path are in one partition, together and in order. A task holds no file, but writes it line by line under a name that Spark's readers
    pass over, and renames it at its end; what a lost task left stays such a name.
    """
    part = f"{folder}.{uuid.uuid4().hex}.tmp"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(part)
        now = out = temporary = None

        def finished() -> None:
            out.close()
            system.move(temporary, f"{root}/{now}")

        for batch in batches:
            paths, values = batch.column("path").to_pylist(), batch.column("value").to_pylist()
            cuts = [i for i in range(len(paths)) if i == 0 or paths[i] != paths[i - 1]] + [len(paths)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if paths[a] != now:
                    if now is not None:
                        finished()
                    now = paths[a]
                    below = f"{root}/{now}".rpartition("/")[0]
                    system.create_dir(below, recursive=True)
                    temporary = f"{below}/_{uuid.uuid4().hex}"
                    out = system.open_output_stream(temporary)
                    out.write(f"{header}\n".encode())
                out.write("".join(f"{v}\n" for v in values[a:b]).encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])
        if now is not None:
            finished()

    system, root = opened(part)
    system.create_dir(root, recursive=True)
    lines.select("path", "value").mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()
    final = opened(folder)[1]
    if system.get_file_info(final).type.name == "Directory":
        system.delete_dir(final)
    system.move(root, final)


def write_files(files: DataFrame, path: str = "path", content: str = "content") -> None:
    """Writes each row's content (binary) to its path. A file is written under another name and then renamed, so none is ever there in part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, data in zip(batch.column(path).to_pylist(), batch.column(content).to_pylist(), strict=True):
                system, name = opened(uri)
                system.create_dir(name.rpartition("/")[0], recursive=True)
                temporary = f"{name}.{uuid.uuid4().hex}.tmp"
                with system.open_output_stream(temporary) as out:
                    out.write(data or b"")
                system.move(temporary, name)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    files.select(path, content).mapInArrow(run, "n long").write.format("noop").mode("overwrite").save()
