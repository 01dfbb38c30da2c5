"""The message log as a data source: ``spark.readStream.format("tidelog")``, and as a sink.

Reading takes raw messages by position: an offset is the position to go on from, a micro-batch holds
``batchSize`` messages for each of ``partitions`` consumers, and a consumer is one task. It does not
matter how the log is cut into files.

Writing takes rows as :meth:`tidelog.sinks.publish.Publisher.log_rows` makes them. Tasks write files
aside and report how many rows each holds; the commit adds these up to positions and shows all files at
once. A batch of a stream that runs again after it was committed adds nothing. With ``strict`` a row that
failed its checks fails the whole job: nothing becomes readable, and the error names the rows.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tidelog.schema import OK, RAW_MESSAGE
from tidelog.sources import logfiles
from tidelog.sources.logfiles import (
    GROUP_ROWS,
    STAGING,
    Log,
    Staged,
    Unit,
    commit,
    exists,
    open_folder,
    read_between,
)

FORMAT = "tidelog"
# Rows that an error names; the rest are counted.
NAMED = 100


def register(spark: SparkSession) -> None:
    """Make the format known to a session.

    Spark runs a source's planning in Python workers that get no files of a session, so what the source
    is made of travels with it.
    """
    for module in (sys.modules[__name__], logfiles):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(QueueSource)


class Slice(InputPartition):
    """One consumer's part of a batch."""

    def __init__(self, units: list[Unit], low: int, high: int):
        super().__init__((low, high))
        self.units, self.low, self.high = units, low, high


class QueueSource(DataSource):
    """Options: ``path``; for streams ``batchSize`` (0: no bound), ``partitions`` and
    ``startPosition``; ``columns``, names with commas, to read fewer. For writing ``strict``; for tables
    that are batches of a stream, ``writer`` and ``batch``, so that a repeated one adds nothing."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _path(self) -> str:
        if not self.options.get("path"):
            raise ValueError("option path is missing")
        return self.options["path"]

    def schema(self) -> StructType:
        chosen = self.options.get("columns")
        names = chosen.split(",") if chosen else RAW_MESSAGE.names
        if unknown := sorted(set(names) - set(RAW_MESSAGE.names)):
            raise ValueError(f"a log has no columns {', '.join(unknown)}")
        return StructType([f for f in RAW_MESSAGE.fields if f.name in names])

    def reader(self, schema: StructType) -> QueueTable:
        return QueueTable(self._path(), schema.names)

    def streamReader(self, schema: StructType) -> QueueStream:
        size, consumers, start = (
            int(self.options.get(n, d))
            for n, d in (("batchSize", 0), ("partitions", 1), ("startPosition", 0))
        )
        if size < 0 or consumers < 1 or start < 0:
            raise ValueError("batchSize and startPosition must be >= 0, partitions above 0")
        return QueueStream(self._path(), schema.names, size, consumers, start)

    def writer(self, schema: StructType, overwrite: bool) -> LogWriter:
        batch = self.options.get("batch")
        return LogWriter(
            self._path(), schema, self._strict(), overwrite, self.options.get("writer"),
            None if batch is None else int(batch),
        )

    def streamWriter(self, schema: StructType, overwrite: bool) -> LogStreamWriter:
        if overwrite:
            raise ValueError("a stream only appends to a log")
        return LogStreamWriter(self._path(), schema, self._strict(), False)

    def _strict(self) -> bool:
        return self.options.get("strict", "true").lower() == "true"


class QueueTable(DataSourceReader):
    """A log as a bounded table, a task for each file or row group."""

    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path, names

    def partitions(self) -> list[Slice]:
        log = Log(self.path)
        log.refresh()
        return [Slice([u], u.low, u.high + 1) for u in log.units]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return read_between(self.path, partition.units, partition.low, partition.high, self.names)


class QueueStream(DataSourceStreamReader):
    """A log as a stream in order of position.

    Spark asks where a batch may end before it says where it starts. The start is the end of the last
    batch planned, which Spark repeats to a new reader when a query restarts.
    """

    def __init__(self, path: str, names: list[str], size: int, consumers: int, start: int):
        self.path, self.names = path, names
        self.size, self.consumers, self.start = size, consumers, start
        self.at: int | None = None
        self.log: Log | None = None
        self.published = False

    def initialOffset(self) -> dict:
        return {"position": self.start}

    def _refreshed(self) -> Log:
        if self.log is None:
            self.log = Log(self.path)
            self.log.refresh()
        else:
            late = [u for u in self.log.refresh() if self.at is not None and u.low < self.at]
            if late:
                raise ValueError(
                    f"{late[0].path} holds position {late[0].low}, but the stream is at {self.at}"
                )
        return self.log

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self.start
        ahead = self.at + self.size * self.consumers
        whole = self.size and self.log and ahead <= self.log.end()
        if whole and (self.published or self.log.unchanged()):
            log = self.log  # a whole batch is known, and nothing came or can come before its end
        else:
            log = self._refreshed()
            self.published = log.grows_at_its_end()
        if not self.size:
            return {"position": max(self.at, log.end())}
        cuts = log.cuts(self.at, self.size, self.consumers)
        return {"position": cuts[-1] if cuts else self.at}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        low, high = start["position"], end["position"]
        self.at = high
        if low >= high:
            return []
        log = self.log or self._refreshed()
        if self.size:
            ends = [e for e in log.cuts(low, self.size, self.consumers) if e < high]
        else:
            ends = [e for e in log.spans(low, high, self.consumers) if low < e < high]
        edges = sorted({low, *ends, high})
        return [Slice(log.between(a, b), a, b) for a, b in zip(edges, edges[1:], strict=False)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return read_between(self.path, partition.units, partition.low, partition.high, self.names)


class FileWritten(WriterCommitMessage):
    """What a task wrote: a file, its rows, and the rows that failed their checks."""

    def __init__(self, part: int, folder: str, writer: str, file: Staged, bad: list[str]):
        self.part, self.folder, self.writer, self.file, self.bad = part, folder, writer, file, bad


class PublishError(Exception):
    """Rows could not be published; none of the job's rows are in the log."""


class _LogWriter:
    def __init__(self, path: str, schema: StructType, strict: bool, overwrite: bool,
                 writer: str | None = None, batch: int | None = None):
        missing = [f.name for f in RAW_MESSAGE.fields if f.name not in schema.names]
        if missing or "status" not in schema.names:
            raise ValueError(
                "the log takes rows that a Publisher made; missing: "
                + ", ".join([*missing, *(["status"] if "status" not in schema.names else [])])
            )
        self.path, self.strict, self.overwrite = path, strict, overwrite
        self.job = uuid.uuid4().hex
        self.writer, self.batch = (writer or self.job).replace("-", ""), batch

    def _place(self) -> tuple[str, int | None]:
        """The writer and batch that a task's rows belong to."""
        return self.writer, self.batch

    def _folder(self, root: str, batch: int | None) -> str:
        return f"{root}/{STAGING}/{self.job}-{batch}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> FileWritten:
        """Write a task's rows aside. Positions and ids come from the place they get, so they are not
        stored."""
        part = TaskContext.get().partitionId()
        writer, batch = self._place()
        fs, root = open_folder(self.path)
        folder = self._folder(root, batch)
        name = f"{part}-{uuid.uuid4().hex}.parquet"
        rows, failed, bad, out = 0, 0, [], None
        for batch_rows in iterator:
            if not batch_rows.num_rows:
                continue
            kept = batch_rows.drop_columns(["spool_seq", "rgmid"])
            if out is None:
                fs.create_dir(folder, recursive=True)
                sink = fs.open_output_stream(f"{folder}/{name}")
                out = pq.ParquetWriter(sink, kept.schema, compression="snappy")
            out.write_batch(kept, row_group_size=GROUP_ROWS)
            rows += batch_rows.num_rows
            for i, status in enumerate(batch_rows.column("status").to_pylist()):
                if status != OK:
                    failed += 1
                    if len(bad) < NAMED:
                        bad.append(f"{batch_rows.column('correlation_id')[i].as_py() or '?'}: "
                                   f"{batch_rows.column('reason')[i].as_py()}")
        if out is not None:
            out.close()
            sink.close()
        return FileWritten(part, folder, writer, Staged(name, rows, failed), bad)

    def _commit(self, messages: list, batch: int | None) -> None:
        written = sorted((m for m in messages if m is not None), key=lambda m: m.part)
        if self.strict and (failed := sum(m.file.failed for m in written)):
            bad = [b for m in written for b in m.bad][:NAMED]
            more = f" and {failed - len(bad)} more" if failed > len(bad) else ""
            raise PublishError(f"{failed} rows cannot be published: {'; '.join(bad)}{more}")
        full = [m for m in written if m.file.rows]
        if full:
            commit(self.path, full[0].folder, [m.file for m in full], full[0].writer, batch,
                   self.overwrite)

    def _abort(self, batch: int | None) -> None:
        fs, root = open_folder(self.path)
        if exists(fs, folder := self._folder(root, batch)):
            fs.delete_dir(folder)


class LogWriter(_LogWriter, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self._commit(messages, self.batch)

    def abort(self, messages: list) -> None:
        self._abort(self.batch)


class LogStreamWriter(_LogWriter, DataSourceStreamArrowWriter):
    """The query's id names the writer; Spark gives it and the batch to every task."""

    def _place(self) -> tuple[str, int | None]:
        task = TaskContext.get()
        query = task.getLocalProperty("sql.streaming.queryId").replace("-", "")
        return query, int(task.getLocalProperty("streaming.sql.batchId"))

    def commit(self, messages: list, batchId: int) -> None:
        self._commit(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self._abort(batchId)
