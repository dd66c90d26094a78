"""Recorded feeds as a Spark data source: batch, or a stream whose offset is the last message of each connection.

A log is a folder of Parquet files that never change, or one file.  A file
belongs to one connection, that of its folder ``conn_id=...`` or else of its own
name, and has its messages in the order of arrival.  Where a stream stands is
the last ``arrival_seq`` of each connection; files' footers tell which row groups
lie between two offsets, so planning reads no messages, a restart asks for the
same ones again, and each row group is a task of its own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "recorded_feed"
MESSAGES = "conn_id string, arrival_seq long, arrival_time timestamp, payload string"


@dataclass
class Part(InputPartition):
    """Messages ``after`` one and up to another of a row group."""

    path: str
    group: int
    conn: str
    after: int
    upto: int

    def __init__(self, path: str, group: int, conn: str, after: int, upto: int) -> None:
        super().__init__(None)
        self.path, self.group, self.conn, self.after, self.upto = path, group, conn, after, upto


class Log:
    """The files of a recorded log, by their footers; a file is looked at once."""

    def __init__(self, options: dict) -> None:
        self.seq, self.time, self.payload = (options.get(k, k) for k in ("arrival_seq", "arrival_time", "payload"))
        if "path" not in options:
            raise ValueError("a recorded feed needs a path")
        path = options["path"]
        self.store, self.base = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))
        self.known: dict[str, list[Part]] = {}

    def _files(self) -> list[str]:
        top = self.store.get_file_info(self.base)
        if top.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.base)
        if top.type == pafs.FileType.File:
            return [self.base]
        found = self.store.get_file_info(pafs.FileSelector(self.base, recursive=True))
        return sorted(x.path for x in found if x.is_file and x.path.endswith(".parquet") and not x.base_name.startswith(("_", ".")))

    def _groups(self, path: str) -> list[Part]:
        meta = pq.ParquetFile(self.store.open_input_file(path)).metadata
        column = meta.schema.names.index(self.seq)
        folder = [x for x in path.split("/") if x.startswith("conn_id=")]
        conn = folder[-1].partition("=")[2] if folder else path.rpartition("/")[2].removesuffix(".parquet")
        out = []
        for k in range(meta.num_row_groups):
            stats = meta.row_group(k).column(column).statistics
            if meta.row_group(k).num_rows:
                if stats is None or not stats.has_min_max:
                    raise ValueError(f"{path} doesn't tell the range of {self.seq}")
                out.append(Part(path, k, conn, stats.min - 1, stats.max))
        return out

    def parts(self) -> list[Part]:
        for path in self._files():
            if path not in self.known:
                self.known[path] = self._groups(path)
        return [part for groups in self.known.values() for part in groups]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        table = pq.ParquetFile(self.store.open_input_file(part.path)).read_row_group(part.group, columns=[self.seq, self.time, self.payload])
        seq = table.column(self.seq).cast(pa.int64())
        table = table.filter(pc.and_(pc.greater(seq, part.after), pc.less_equal(seq, part.upto)))
        time = table.column(self.time)
        if pa.types.is_timestamp(time.type) and time.type.tz is None:
            time = pc.assume_timezone(time.cast(pa.timestamp("us")), "UTC")
        columns = [pa.array([part.conn] * table.num_rows, pa.string()), table.column(self.seq).cast(pa.int64()), time.cast(pa.timestamp("us", "UTC")), table.column(self.payload).cast(pa.string())]
        yield from pa.table(columns, ["conn_id", "arrival_seq", "arrival_time", "payload"]).to_batches(max_chunksize=10_000)


class BatchReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[Part]:
        return Log(self.options).parts()

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return Log(self.options).read(partition)


class StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.options, self.log = options, None

    def _log(self) -> Log:
        if self.log is None:
            self.log = Log(self.options)
        return self.log

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        last: dict[str, int] = {}
        for part in self._log().parts():
            last[part.conn] = max(part.upto, last.get(part.conn, part.upto))
        return last

    def partitions(self, start: dict, end: dict) -> list[Part]:
        out = []
        for p in self._log().parts():
            after, upto = max(p.after, start.get(p.conn, p.after)), min(p.upto, end.get(p.conn, p.after))
            if after < upto:
                out.append(Part(p.path, p.group, p.conn, after, upto))
        return out

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return Log(self.options).read(partition)

    def commit(self, end: dict) -> None:
        """Nothing to let go of: files stay."""

    def __getstate__(self) -> dict:
        return {"options": self.options, "log": None}


class RecordedFeed(DataSource):
    """Options: ``path``, and the columns ``arrival_seq``, ``arrival_time`` and ``payload`` if they have other names."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return MESSAGES

    def _plain(self) -> dict:
        return json.loads(json.dumps(dict(self.options)))

    def reader(self, schema) -> BatchReader:  # noqa: ANN001
        return BatchReader(self._plain())

    def streamReader(self, schema) -> StreamReader:  # noqa: ANN001, N802
        return StreamReader(self._plain())


def register(spark: SparkSession) -> str:
    """Makes the source known to a session; returns its name, for ``format``."""
    spark.dataSource.register(RecordedFeed)
    return NAME
