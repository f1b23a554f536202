"""Export of text lines to files, each line once even if a batch is repeated.

A stream writer with commit and abort: tasks write to files of their own that nobody
reads, the driver puts them in place when all tasks are done, and a mark says that the
batch is complete. A batch that comes again after its mark is dropped; one that failed
half-way is replaced. ``read_lines`` reads marked batches only.

    register(spark)
    lines.writeStream.format("audit_lines").option("path", "/out").option("checkpointLocation", "/ck").start()

Lines of a few hundred attributes repeat themselves: with the option ``compression``, ``gzip``,
files hold a twelfth of the bytes or so. Such a file is read by one task, so that a task
goes on to another file after ``FILE_BYTES`` of text.

Files go through Arrow's file systems, so ``path`` may be a local path or a URI they know;
on a cluster it must be a folder that driver and executors share.
"""

from __future__ import annotations

import gzip
from collections.abc import Callable, Iterator
from contextlib import ExitStack
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming.query import StreamingQuery

FORMAT = "audit_lines"
#: Lines written to a file at once.
CHUNK = 1 << 20
#: Bytes of text after which a task begins another file; readers put some 24 such files into a task.
FILE_BYTES = 16 << 20
#: What the option ``compression`` may be, and the endings of the files, by which readers know it.
ENDINGS = {"none": ".txt", "gzip": ".txt.gz"}


@dataclass
class Written(WriterCommitMessage):
    """The files a task has written, each with its lines."""

    files: list[tuple[str, int]]


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path.rstrip("/")
    system, root = fs.FileSystem.from_uri(path)
    return system, root.rstrip("/")


def _text(lines: pa.Array) -> pa.Buffer:
    """The lines one after the other, each with its end, as Arrow holds them."""
    nothing, end = (pa.scalar(t, pa.large_string()) for t in ("", "\n"))
    ended = pc.binary_join_element_wise(lines.cast(pa.large_string()), nothing, end)
    offsets = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset:ended.offset + len(ended) + 1]
    return ended.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0]))


class LinesWriter(DataSourceStreamArrowWriter):
    """Writes the one text column of its rows as lines; NULL is no line."""

    def __init__(self, path: str, compression: str = "none"):
        self.path, self.compression = path, compression

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = _open(self.path)
        system.create_dir(f"{root}/_pending")
        files, size = [], FILE_BYTES
        with ExitStack() as opened:
            for batch in iterator:
                values = batch.column(0).drop_null()
                for at in range(0, len(values), CHUNK):
                    part = values[at:at + CHUNK]
                    if size >= FILE_BYTES:
                        opened.close()
                        files.append((uuid4().hex, 0))
                        out, size = opened.enter_context(system.open_output_stream(f"{root}/_pending/{files[-1][0]}")), 0
                        if self.compression == "gzip":
                            # With the least effort, which finds what repeats itself all the same.
                            out = opened.enter_context(gzip.GzipFile(fileobj=out, mode="wb", compresslevel=1, mtime=0))
                    text = _text(part)
                    out.write(text)
                    files[-1], size = (files[-1][0], files[-1][1] + len(part)), size + text.size
        return Written(files)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        system, root = _open(self.path)
        mark = f"{root}/_done/{batchId}"
        if system.get_file_info(mark).type == fs.FileType.File:
            self.abort(messages, batchId)
            return
        folder = f"{root}/batch={batchId}"
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir_contents(folder)  # of an attempt that did not get as far as its mark
        system.create_dir(folder)
        files = [file for message in messages if message is not None for file in message.files]
        for i, (name, _) in enumerate(files):
            system.move(f"{root}/_pending/{name}", f"{folder}/part-{i:05d}{ENDINGS[self.compression]}")
        system.create_dir(f"{root}/_done")
        with system.open_output_stream(mark) as out:
            out.write(str(sum(lines for _, lines in files)).encode())

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        system, root = _open(self.path)
        for message in messages:
            for name, _ in message.files if message is not None else ():
                file = f"{root}/_pending/{name}"
                if system.get_file_info(file).type == fs.FileType.File:
                    system.delete_file(file)


class LinesExport(DataSource):
    """The sink ``audit_lines``; its option ``path`` is the target folder, ``compression`` the form of its files."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> LinesWriter:
        path = self.options.get("path")
        if not path or len(schema.fields) != 1 or schema.fields[0].dataType.simpleString() != "string":
            raise ValueError(f"{FORMAT} takes one text column and the option path")
        compression = self.options.get("compression", "none")
        if compression not in ENDINGS:
            raise ValueError(f"{FORMAT} knows the compressions {', '.join(ENDINGS)}")
        return LinesWriter(path, compression)


def register(spark: SparkSession) -> None:
    """Make the sink known to a session."""
    spark.dataSource.register(LinesExport)


def export(lines: DataFrame, path: str, checkpoint: str, start: Callable, compression: str = "none") -> StreamingQuery:
    """Start the export of a stream of lines; ``start`` sets the trigger of a stream writer and starts it."""
    register(lines.sparkSession)
    return start(lines.writeStream.format(FORMAT).option("path", path).option("compression", compression).option(
        "checkpointLocation", checkpoint))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all complete batches (column ``value``)."""
    system, root = _open(path)
    done = system.get_file_info(fs.FileSelector(f"{root}/_done", allow_not_found=True))
    found = [f"{path.rstrip('/')}/batch={info.base_name}" for info in done if info.type == fs.FileType.File and int(
        system.open_input_stream(info.path).read() or 0)]
    if not found:
        return spark.createDataFrame([], "value string")
    return spark.read.text(sorted(found))
