"""A growing log of raw records, and a live stream of it that is paced by records.

Writers append whole batches: Spark writes the files, then one small entry in the log gives them
their record offsets, from the first record of the log on. An entry counts from the moment it
appears under its name, so readers see all records of an append or none.

The stream's offsets are record offsets. A micro-batch takes at most ``recordsPerBatch`` records, cut
inside files where need be, and is split into tasks of at most ``recordsPerTask``. Spark's
checkpoint holds the offsets: a restarted query repeats the batch that was not finished, with the
same records, and goes on behind it.

    append(records, "/shared/log")
    register(spark)
    raw = read_log_stream(spark, "/shared/log", records_per_batch=100_000, progress="/shared/progress")
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from traceframe.schema import RAW_EVENTS
from traceframe.streaming import files
from traceframe.workers import visible

FORMAT = "trace_record_log"
#: Records in one micro-batch and in one task, unless given as options.
RECORDS_PER_BATCH = 1_000_000
RECORDS_PER_TASK = 100_000


def _where(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _uri(path: str) -> str:
    return path.replace("file:///", "file:/").replace("file:/", "file:///") if path.startswith("file:") else path


@dataclass(frozen=True)
class Entry:
    """One append: its files with their record counts, and the offset of its first record."""

    first: int
    files: tuple[tuple[str, int], ...]

    @property
    def end(self) -> int:
        return self.first + sum(n for _, n in self.files)


def entry_name(number: int) -> str:
    return f"log/{number:012d}.json"


def append(records: DataFrame, path: str) -> Entry:
    """Append the records of a frame, in the order of its partitions."""
    spark = records.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    records.write.parquet(f"{path}/{folder}")
    system, root = _where(_uri(path))
    parts = []
    for name in files.names(spark, f"{path}/{folder}"):
        if name.endswith(".parquet"):
            n = pa.parquet.read_metadata(f"{root}/{folder}/{name}", filesystem=system).num_rows
            parts.append((f"{folder}/{name}", n))
    while True:
        log = Log(path)
        number, first = len(log.entries), log.end
        value = {"first": first, "files": [list(p) for p in parts]}
        # Another writer may have taken the number: look again.
        if files.put_new(spark, f"{path}/{entry_name(number)}", value):
            return Entry(first, tuple(parts))


class Log:
    """The entries of a log, read once each."""

    def __init__(self, path: str):
        self.system, self.root = _where(_uri(path))
        self.entries: list[Entry] = []
        self.refresh()

    @property
    def end(self) -> int:
        return self.entries[-1].end if self.entries else 0

    def refresh(self) -> None:
        while True:
            try:
                with self.system.open_input_stream(f"{self.root}/{entry_name(len(self.entries))}") as f:
                    value = json.loads(f.read())
            except FileNotFoundError:
                return
            self.entries.append(Entry(value["first"], tuple((name, n) for name, n in value["files"])))

    def slices(self, start: int, end: int) -> Iterator[tuple[str, int, int, int]]:
        """(file, its first row, its end row, offset of that first row) of the records in a range."""
        for entry in self.entries:
            if entry.end <= start or entry.first >= end:
                continue
            at = entry.first
            for name, n in entry.files:
                low, high = max(start, at), min(end, at + n)
                if low < high:
                    yield name, low - at, high - at, low
                at += n


@dataclass
class Slice(InputPartition):
    file: str
    begin: int
    end: int


class RecordLogReader(DataSourceStreamReader):
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.columns = options["path"], columns
        self.per_batch = int(options.get("recordsperbatch", RECORDS_PER_BATCH))
        self.per_task = int(options.get("recordspertask", RECORDS_PER_TASK))
        self.start = int(options.get("startoffset", 0))
        # Where the planned records end outlives this reader, as a restart does not say where it goes on.
        self.system, self.note = _where(_uri(options["progress"]))
        if self.per_batch < 1 or self.per_task < 1:
            raise ValueError("a batch and a task take at least one record")
        self.log: Log | None = None
        self.planned: int | None = None

    def initialOffset(self) -> dict:
        return {"record": self.start}

    def latestOffset(self) -> dict:
        self._refresh()
        if self.planned is None:
            self.planned = max(self.start, self._noted())
        return {"record": max(self.planned, min(self.log.end, self.planned + self.per_batch))}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        self._refresh()
        low, high = start["record"], end["record"]
        if high > self.log.end:
            raise ValueError(f"{self.path} ends at record {self.log.end}, before {high}: records are gone")
        out = []
        for name, begin, stop, _ in self.log.slices(low, high):
            out += [Slice(name, i, min(i + self.per_task, stop)) for i in range(begin, stop, self.per_task)]
        self.planned = max(self.planned or 0, high)
        self._note(self.planned)
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        system, root = _where(_uri(self.path))
        with system.open_input_file(f"{root}/{partition.file}") as f:
            source, at = pa.parquet.ParquetFile(f), 0
            for group in range(source.num_row_groups):
                n = source.metadata.row_group(group).num_rows
                if at + n > partition.begin and at < partition.end:
                    for batch in source.iter_batches(row_groups=[group], columns=self.columns):
                        low, high = max(partition.begin - at, 0), min(partition.end - at, len(batch))
                        if low < high:
                            yield batch.slice(low, high - low).select(self.columns)
                        at += len(batch)
                else:
                    at += n

    def _refresh(self) -> None:
        if self.log is None:
            self.log = Log(self.path)
        else:
            self.log.refresh()

    def _noted(self) -> int:
        try:
            with self.system.open_input_stream(self.note) as f:
                return int(f.read() or 0)
        except FileNotFoundError:
            return 0

    def _note(self, record: int) -> None:
        self.system.create_dir(self.note.rsplit("/", 1)[0], recursive=True)
        part = f"{self.note}.{uuid.uuid4().hex}"
        with self.system.open_output_stream(part) as f:
            f.write(str(record).encode())
        self.system.move(part, self.note)


class RecordLog(DataSource):
    """Data source of a record log: options ``path``, ``progress``, ``recordsPerBatch``, ``recordsPerTask``, ``startOffset``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RAW_EVENTS

    def streamReader(self, schema) -> RecordLogReader:
        options = {k.lower(): v for k, v in self.options.items()}
        for needed in ("path", "progress"):
            if needed not in options:
                raise ValueError(f"a record log needs the option {needed}")
        return RecordLogReader(options, schema.names)


def register(spark: SparkSession) -> None:
    visible(spark)
    spark.dataSource.register(RecordLog)


def read_log_stream(
    spark: SparkSession,
    path: str,
    *,
    progress: str,
    records_per_batch: int = RECORDS_PER_BATCH,
    records_per_task: int = RECORDS_PER_TASK,
) -> DataFrame:
    """The records of a log as a live stream. ``progress`` is a file of this query's own, kept with its checkpoint."""
    register(spark)
    return (
        spark.readStream.format(FORMAT)
        .option("path", path)
        .option("progress", progress)
        .option("recordsPerBatch", records_per_batch)
        .option("recordsPerTask", records_per_task)
        .load()
    )
