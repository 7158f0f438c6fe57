"""Growing log files as a streaming source: offsets are bytes, and a stream may start at the end.

``spark.readStream.format("log_tail").option("path", folder).load()`` yields (value, file) lines. A
micro-batch takes what was appended up to the last line end of every file; a line that is still being
written waits. Long stretches are split, so one file does not hold one task for long.

Options: ``path``, a folder all executors reach, as a path or a URI that Arrow's file systems know;
``startingOffsets``, ``latest`` (the default: only lines written after the start) or ``earliest``;
``start``, a file that keeps the first offsets, so that a stream that failed in its first micro-batch
begins where it began; ``splitBytes``, the bytes of one task.
"""

from __future__ import annotations

import json
import posixpath
import sys
from collections.abc import Iterator

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Executors get the reader by value and need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT_BYTES = 32 << 20
_LOOK = 64 << 10


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


class Stretch(InputPartition):
    """Lines of a file that begin at bytes ``start`` to ``stop``; ``limit`` ends the last one."""

    def __init__(self, file: str, start: int, stop: int, limit: int, first: int):
        super().__init__(None)
        self.file, self.start, self.stop, self.limit, self.first = file, start, stop, limit, first


class LogTailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        # Spark hands option names over in lower case.
        options = {name.lower(): value for name, value in options.items()}
        self.folder = options["path"].rstrip("/")
        self.starting = options.get("startingoffsets", "latest")
        if self.starting not in ("latest", "earliest"):
            raise ValueError(f"startingOffsets is latest or earliest, not {self.starting!r}")
        self.start_file = options.get("start")
        self.split = int(options.get("splitbytes", SPLIT_BYTES))

    def initialOffset(self) -> dict:
        kept = self._kept_start()
        if kept is not None:
            return kept
        begin = self.latestOffset() if self.starting == "latest" else {}
        if self.start_file:
            system, path = _opened(self.start_file)
            system.create_dir(posixpath.dirname(path), recursive=True)
            with system.open_output_stream(path) as out:
                out.write(json.dumps(begin).encode())
        return begin

    def _kept_start(self) -> dict | None:
        if not self.start_file:
            return None
        system, path = _opened(self.start_file)
        if system.get_file_info(path).type != fs.FileType.File:
            return None
        with system.open_input_stream(path) as kept:
            return json.loads(kept.read())

    def latestOffset(self) -> dict:
        """The end of the last whole line of every file, by name."""
        system, folder = _opened(self.folder)
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        logs = [i for i in found if i.type == fs.FileType.File and not i.base_name.startswith(("_", "."))]
        return {i.base_name: _line_end(system, i.path, i.size) for i in sorted(logs, key=lambda i: i.base_name)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out: list[InputPartition] = []
        for file, stop in sorted(end.items()):
            begin = start.get(file, 0)
            if begin > stop:
                raise ValueError(f"{file} had {begin} bytes and has {stop}: log files only grow")
            out += [Stretch(file, at, min(at + self.split, stop), stop, begin) for at in range(begin, stop, self.split)]
        return out

    def read(self, partition: Stretch) -> Iterator[tuple[str, str]]:
        system, folder = _opened(self.folder)
        with system.open_input_file(f"{folder}/{partition.file}") as log:
            # A line belongs to the stretch it begins in; what an earlier stretch began is passed over.
            at = partition.start
            log.seek(at - 1 if at > partition.first else at)
            buffer = b""
            if at > partition.first:
                at -= 1
            skip = at != partition.start
            while at < partition.stop:
                cut = buffer.find(b"\n")
                if cut < 0:
                    more = log.read(min(_LOOK, partition.limit - at - len(buffer)))
                    if not more:
                        return
                    buffer += more
                    continue
                line, buffer = buffer[:cut], buffer[cut + 1 :]
                if not skip:
                    yield line.removesuffix(b"\r").decode("utf-8", "replace"), partition.file
                skip = False
                at += cut + 1

    def commit(self, end: dict) -> None:
        pass


def _line_end(system: fs.FileSystem, path: str, size: int) -> int:
    """The byte after the last line end of a file."""
    with system.open_input_file(path) as log:
        high = size
        while high:
            low = max(0, high - _LOOK)
            log.seek(low)
            cut = log.read(high - low).rfind(b"\n")
            if cut >= 0:
                return low + cut + 1
            high = low
    return 0


class LogTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return "value string, file string"

    def streamReader(self, schema) -> LogTailReader:
        return LogTailReader(dict(self.options))


def source_log_tail(spark: SparkSession, path: str, starting: str = "latest", start: str | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines (value, file) appended to the files of a folder; see the options above."""
    spark.dataSource.register(LogTail)
    options = {"path": path, "startingOffsets": starting, "splitBytes": str(split_bytes)}
    return spark.readStream.format("log_tail").options(**options, **({"start": start} if start else {})).load()
