"""FASTA as a data source: byte ranges read in parallel, files written with commit.

``cladeframe_fasta`` reads.  A scan of any number of files is planned from names and sizes
alone: large files are cut into ranges, small ones share a task.  A record belongs to the
range that holds the line break before its ``>``; the first record of a file to the range
at its start.  What precedes the first record of a file is dropped.

``cladeframe_lines`` writes rows ``file, value`` as lines of named files.  Tasks write into a
staging folder of the run; the files of successful tasks are moved to their places when
all have succeeded, and the staging folder goes with whatever failed or repeated tasks
left in it.  ``cladeframe_digests`` reads MD5 sums of files, whole or in chunks, in constant
memory.
"""

from __future__ import annotations

import bz2
import gzip
import hashlib
import json
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .splitting import Chunks, decoded
from .storage import list_files, read_range, resolve

SPLIT_BYTES = 64 << 20
#: Ranges smaller than that share tasks, when there would be more tasks than this.
TASKS = 128
#: What opening a file counts for when small files are put together.
OPEN_BYTES = 1 << 20
#: Bytes of sequence in a batch of records.
BATCH_BYTES = 4 << 20
#: Times a staging folder is tried to be deleted.
DROP_TRIES = 20
WHITE = b" \t\n\x0b\x0c\r"

RECORDS = "path string, file_idx int, block bigint, seq bigint, header string, sequence string"
DIGESTS = "path string, name string, chunk bigint, n_bytes bigint, md5 string, head string, size_bytes bigint, modified_time timestamp"


@dataclass
class Range(InputPartition):
    """Parts of files: ``(path, file number, start, end, size)``."""

    parts: list[tuple[str, int, int, int, int]]


def plan_ranges(options: dict[str, str]) -> list[Range]:
    """Ranges of about ``splitbytes`` over all files of the JSON list ``paths``; a folder
    stands for its files whose names match ``pattern``.  Many small ranges that follow each
    other are one task's work, so that the number of tasks does not grow with the input."""
    split = int(options.get("splitbytes") or SPLIT_BYTES)
    pattern = re.compile(options.get("pattern") or "")
    parts = []
    for index, path in enumerate(json.loads(options["paths"])):
        for info in list_files(path, options.get("recursive") == "true"):
            if info.path != resolve(path)[1] and not pattern.search(info.base_name):
                continue
            scheme = path[: path.index("://") + 3] if "://" in path and not path.startswith("file:") else ""
            parts += [
                (scheme + info.path, index, start, min(start + split, info.size), info.size)
                for start in range(0, info.size, split)
            ]
    limit = max(split, min(SPLIT_BYTES, sum(part[3] - part[2] for part in parts) // TASKS))
    out: list[Range] = []
    held, total = [], 0
    for part in parts:
        opened = 0 if held and held[-1][:2] == part[:2] else OPEN_BYTES
        if held and total + part[3] - part[2] + opened > limit:
            out.append(Range(held))
            held, total, opened = [], 0, OPEN_BYTES
        held.append(part)
        # the first file of a task is opened in any case
        total += part[3] - part[2] + (opened if len(held) > 1 else 0)
    return out + [Range(held)] if held else out


def record_bodies(chunks: Chunks, at_start: bool) -> Iterator[bytes]:
    """Records of a range: header line and sequence lines, without the ``>``."""
    parts: list[bytes] | None = None  # of the open record
    newline = mine = at_start  # the last byte is a line break; it is the range's own
    for data, own in chunks:
        if not data:
            continue
        cut = 0
        start, owned = (0, mine) if newline and data[:1] == b">" else (data.find(b"\n>") + 1, own)
        while start > 0 or data[:1] == b">" and newline and not cut:
            if parts is not None:
                yield b"".join([*parts, data[cut:start]])
                parts = None
            if not owned:
                return
            parts, cut = [], start + 1
            start, owned = data.find(b"\n>", cut) + 1, own
        if parts is not None:
            parts.append(data[cut:])
        elif not own:
            return
        newline, mine = data[-1:] == b"\n", own
    if parts is not None:
        yield b"".join(parts)


class FastaReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def partitions(self) -> list[Range]:
        return plan_ranges({k.lower(): v for k, v in self.options.items()}) or [Range([])]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORDS.split(", ")]
        types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        schema = pa.schema(list(zip(names, types)))
        rows: list[tuple] = []
        held = 0
        for (path, index), ranges in groupby(partition.parts, lambda part: part[:2]):
            system, plain = resolve(path)
            with system.open_input_file(plain) as handle:
                for _, _, start, end, size in ranges:
                    for seq, body in enumerate(record_bodies(decoded(handle, start, end, size), start == 0)):
                        header, _, rest = body.partition(b"\n")
                        sequence = rest.translate(None, WHITE)
                        header = header.split(b"\r")[0].decode("utf-8", "replace")
                        rows.append((path, index, start, seq, header, sequence.decode("utf-8", "replace")))
                        held += len(sequence) + len(header) + 100
                        if held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema=schema)


class FastaSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cladeframe_fasta"

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema) -> FastaReader:
        return FastaReader(self.options)


class DigestReader(DataSourceReader):
    """One row a chunk: its MD5; with ``headonly``, only the first bytes are read."""

    def __init__(self, options: dict[str, str]):
        self.options = {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[Range]:
        chunk = int(self.options.get("chunkbytes") or 0)
        return plan_ranges({**self.options, "splitbytes": str(chunk or 1 << 62)}) if chunk else self._whole()

    def _whole(self) -> list[Range]:
        ranges = plan_ranges({**self.options, "splitbytes": str(1 << 62)})
        # many small files share a task, a large one has its own
        out: list[Range] = []
        held, total = [], 0
        for part in (p for r in ranges for p in r.parts):
            if held and total + part[4] + OPEN_BYTES > SPLIT_BYTES:
                out.append(Range(held))
                held, total = [], 0
            held.append(part)
            total += part[4] + OPEN_BYTES
        return (out + [Range(held)] if held else out) or [Range([])]

    def read(self, partition: Range) -> Iterator[tuple]:
        chunk = int(self.options.get("chunkbytes") or 0)
        head_only = self.options.get("headonly") == "true"
        for path, _, start, end, size in partition.parts:
            system, plain = resolve(path)
            info = system.get_file_info(plain)
            state, head = hashlib.md5(usedforsecurity=False), b""
            with system.open_input_file(plain) as handle:
                for data in read_range(handle, start, min(end, start + 16) if head_only else end):
                    head = head or data[:16]
                    state.update(data)
            digest = None if head_only else state.hexdigest()
            yield path, info.base_name, start // chunk if chunk else 0, end - start, digest, head.hex(), size, info.mtime


class DigestSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cladeframe_digests"

    def schema(self) -> str:
        return DIGESTS

    def reader(self, schema) -> DigestReader:
        return DigestReader(self.options)


@dataclass
class Staged(WriterCommitMessage):
    """Files a task has written: ``(place in the staging folder, place in the target)``."""

    files: list[tuple[str, str]]


class LineWriter(DataSourceArrowWriter):
    """Lines of named files.  ``naming`` ``exact``: a file is written by one task, under its
    name; ``parts``: each task adds a part file to the folder of that name."""

    def __init__(self, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}
        self.target = options["path"].rstrip("/")
        self.exact = options.get("naming") == "exact"
        self.suffix = options.get("suffix") or ""
        self.compression = options.get("compression") or ""
        self.staging = f"{self.target}/_staging-{uuid.uuid4().hex}"
        # made here only: a task that goes on after the run has failed can't make it anew
        system, staging = resolve(self.staging)
        system.create_dir(staging, recursive=True)

    def _open(self, system: fs.FileSystem, place: str):
        folder = place.rpartition("/")[0]
        if system.get_file_info(folder).type != fs.FileType.Directory:
            system.create_dir(folder, recursive=False)
        stream = system.open_output_stream(place)
        if self.compression == "gzip":
            return gzip.GzipFile(fileobj=stream, mode="wb", mtime=0), stream
        if self.compression == "bzip2":
            return bz2.BZ2File(stream, "wb"), stream
        return stream, stream

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        task = TaskContext.get()
        system, staging = resolve(self.staging)
        attempt = f"{staging}/{task.partitionId():05d}-{task.taskAttemptId()}"
        files: list[tuple[str, str]] = []
        name, out, raw = None, None, None
        for batch in iterator:
            columns = batch.to_pydict()
            for file, value in zip(columns["file"], columns["value"]):
                if file != name:
                    # rows come sorted by file, so one is open at a time
                    _close(out, raw)
                    name = file
                    staged = f"{attempt}/{len(files)}"
                    final = f"{name}{self.suffix}" if self.exact else f"{name}/part-{task.partitionId():05d}{self.suffix}"
                    files.append((staged, final))
                    out, raw = self._open(system, staged)
                out.write(value.encode() + b"\n")
        _close(out, raw)
        return Staged(files)

    def commit(self, messages: list[Staged | None]) -> None:
        system, staging = resolve(self.staging)
        target = resolve(self.target)[1]
        moves = [f for m in messages if m for f in m.files]
        if len({final for _, final in moves}) < len(moves):
            self.abort(messages)
            raise ValueError("a file has rows in several tasks or apart from each other; repartition and sort by file")
        system.create_dir(target, recursive=True)
        for folder in {f"{target}/{final}".rpartition("/")[0] for _, final in moves}:
            system.create_dir(folder, recursive=True)
        for staged, final in moves:
            system.move(staged, f"{target}/{final}")
        self._drop(system, staging)
        with system.open_output_stream(f"{target}/_SUCCESS"):
            pass

    def abort(self, messages: list[Staged | None]) -> None:
        self._drop(*resolve(self.staging))

    @staticmethod
    def _drop(system: fs.FileSystem, staging: str) -> None:
        for attempt in range(DROP_TRIES):
            if system.get_file_info(staging).type != fs.FileType.Directory:
                return
            try:
                system.delete_dir(staging)
            except OSError:
                # a task that has not ended yet has added a file meanwhile
                if attempt == DROP_TRIES - 1:
                    raise
                time.sleep(0.1)


def _close(out, raw) -> None:
    if out is not None:
        out.close()
        if raw is not out:
            raw.close()


class LineSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cladeframe_lines"

    def schema(self) -> str:
        return "file string, value string"

    def writer(self, schema, overwrite: bool) -> LineWriter:
        if overwrite:
            raise ValueError("cladeframe_lines only adds files")
        return LineWriter(self.options)


def register(spark: SparkSession) -> None:
    for source in (FastaSource, DigestSource, LineSink):
        spark.dataSource.register(source)
