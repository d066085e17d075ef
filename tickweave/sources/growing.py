"""Text files that are appended to in place, as a stream of their complete lines.

An offset is how many bytes of each file have been read, up to and with a line end; what stands behind the last
line end (a line that is being written, or torn) waits until its end is there. A batch is cut into ranges of
bytes, which tasks read; each takes the lines that begin in its range.

    spark.dataSource.register(GrowingLines)
    spark.readStream.format("growing_lines").option("path", root).option("pattern", "manifest.jsonl").load()

A file that is shorter than what was read of it gives nothing until it has grown past that again.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator, Sequence

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from . import files

#: Bytes that a task reads of a file.
RANGE = 64 << 20


class GrowingLines(DataSource):
    """Options: path (a folder, searched with all below it), pattern (of file names), range (bytes a task)."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "path string, at long, value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LineReader(self.options["path"], self.options.get("pattern", "*"), int(self.options.get("range", RANGE)))


class LineReader(DataSourceStreamReader):
    def __init__(self, root: str, pattern: str, size: int):
        self.root, self.pattern, self.size = root, pattern, size
        self.known: dict[str, tuple[int, int]] = {}  # a file's size when it was looked at, and the end of its last whole line

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        from pyarrow import fs

        system, root = files.opened(self.root)
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if info.type == fs.FileType.File and fnmatch.fnmatchcase(info.base_name, self.pattern):
                size, cut = self.known.get(info.path, (0, 0))
                if info.size > size:
                    self.known[info.path] = info.size, line_end(system, info.path, cut, info.size)
        return {path: cut for path, (_, cut) in sorted(self.known.items()) if cut}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        out = []
        for path, stop in end.items():
            begin = start.get(path, 0)
            out += [InputPartition((path, a, min(a + self.size, stop), begin, stop)) for a in range(begin, stop, self.size)]
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path, a, b, begin, stop = partition.value
        system, _ = files.opened(self.root)
        with system.open_input_file(path) as f:
            yield from ((path, at, line.decode("utf-8", "replace")) for at, line in lines_of(f, a, b, begin, stop))


def line_end(system, path: str, start: int, size: int, block: int = 1 << 16) -> int:
    """The place behind the last line end of a file's bytes up to size, start if there is none behind it; read from the back."""
    with system.open_input_file(path) as f:
        stop = size
        while stop > start:
            a = max(start, stop - block)
            f.seek(a)
            at = f.read(stop - a).rfind(b"\n")
            if at >= 0:
                return a + at + 1
            stop = a
    return start


def lines_of(f, a: int, b: int, begin: int, stop: int, block: int = files.BLOCK) -> Iterator[tuple[int, bytes]]:
    """Lines that begin from a to b, with where; the file is read from begin to stop, both behind line ends."""
    f.seek(max(begin, a - 1))
    at, held = f.tell(), b""
    skip = a > begin  # up to the line end before a's first line
    while at < b:
        more = f.read(min(block, stop - at - len(held)))
        if not more:
            return
        held += more
        begun = 0
        while (cut := held.find(b"\n", begun)) >= 0:
            if skip:
                skip = False
            elif at + begun < b:
                yield at + begun, held[begun:cut].removesuffix(b"\r")
            else:
                return
            begun = cut + 1
        held, at = held[begun:], at + begun
