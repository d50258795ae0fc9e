"""A partitioned log of keyed records in files, as a Spark data source and sink.

Folder layout: ``segments/`` holds parquet files of records, ``epochs/`` one small JSON file
per committed epoch.  An epoch lists its segments with their partition, first offset and
count, the next offset of every partition, and the last epoch of every writer.  A
segment counts only once an epoch names it, so files of failed or repeated tasks are never
read, and an epoch that a restarted stream writes again is skipped.

    record_log.register(spark)
    df.writeStream.format("record_log").option("path", p).option("writer", "w").option("partitions", 8)
    spark.readStream.format("record_log").option("path", p).option("startingOffsets", "latest")

Reading, as a batch or a stream, gives (topic, partition, offset, key, value); offsets rise
by one within a partition and repeat between partitions.  Options of the stream:
``startingOffsets`` (``earliest``, ``latest`` or a JSON object of partition to offset) and
``maxRecordsPerTrigger``, which needs a ``group``: the plan of the newest micro-batch is
noted under that name, so a restarted stream goes on in steps of the limit.

Writing takes (key, value) as strings.  A key's records stay in order in one partition, by
the CRC of the key; records without a key go to partition 0.  One writer commits at a
time.  Paths are those of any store that Arrow reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

SCHEMA = "topic string, partition int, offset long, key string, value string"
PARTITIONS = 8
SEGMENT_RECORDS = 100_000
_RECORDS = pa.schema([("key", pa.string()), ("value", pa.string())])


# ---- the files ----------------------------------------------------------------------

def _store(path: str):
    """(Arrow file system, path in it)."""
    from pyarrow import fs
    if path.startswith("file:/"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class LogFiles:
    """Segments and epochs under a path."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _names(self, folder: str) -> list[str]:
        from pyarrow import fs
        store, root = _store(self.path)
        found = store.get_file_info(fs.FileSelector(f"{root}/{folder}", allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name.endswith(".json") and not f.base_name.startswith("."))

    def read_json(self, name: str) -> dict | None:
        from pyarrow import fs
        store, root = _store(self.path)
        if store.get_file_info(f"{root}/{name}").type != fs.FileType.File:
            return None
        with store.open_input_stream(f"{root}/{name}") as f:
            return json.loads(f.read())

    def write_json(self, name: str, content: dict) -> None:
        """Whole or not at all: written beside, then moved."""
        store, root = _store(self.path)
        folder, base = name.rsplit("/", 1)
        store.create_dir(f"{root}/{folder}")
        beside = f"{root}/{folder}/.{base}.{uuid.uuid4().hex}"
        with store.open_output_stream(beside) as f:
            f.write(json.dumps(content).encode())
        store.move(beside, f"{root}/{name}")

    def epochs(self) -> list[str]:
        return self._names("epochs")

    def last(self) -> dict:
        """The newest epoch's note."""
        names = self.epochs()
        return self.read_json(f"epochs/{names[-1]}") if names else {"ends": {}, "writers": {}}

    def write_segments(self, records: Iterator[pa.RecordBatch], partitions: int) -> list[dict]:
        """Files of the records by partition, not committed yet; memory is bounded by a segment per partition."""
        import pyarrow.parquet as pq
        store, root = _store(self.path)
        store.create_dir(f"{root}/segments")
        held: dict[int, list] = {}
        count: dict[int, int] = {}
        done = []

        def flush(p: int) -> None:
            name = f"{uuid.uuid4().hex}.parquet"
            table = pa.Table.from_batches(held.pop(p), _RECORDS)
            pq.write_table(table, f"{root}/segments/{name}", filesystem=store)
            done.append({"partition": p, "name": name, "count": table.num_rows})
            count.pop(p)

        for batch in records:
            batch = pa.RecordBatch.from_arrays([batch.column(c).cast(pa.string()) for c in ("key", "value")], schema=_RECORDS)
            of = pa.array([0 if k is None else crc32(k.encode()) % partitions for k in batch.column(0).to_pylist()], pa.int32())
            for p in of.unique().to_pylist():
                part = batch.filter(pc.equal(of, p))
                held.setdefault(p, []).append(part)
                count[p] = count.get(p, 0) + part.num_rows
                if count[p] >= SEGMENT_RECORDS:
                    flush(p)
        for p in list(held):
            flush(p)
        return done

    def commit(self, segments: list[dict], writer: str, epoch: int | None) -> None:
        """Name segments in a new epoch file; an epoch that the writer committed before is skipped."""
        last = self.last()
        if epoch is not None and last["writers"].get(writer, -1) >= epoch:
            self.remove(segments)
            return
        ends = {k: v for k, v in last["ends"].items()}
        placed = []
        for s in segments:
            p = str(s["partition"])
            placed.append({**s, "first": ends.get(p, 0)})
            ends[p] = ends.get(p, 0) + s["count"]
        names = self.epochs()
        nr = int(names[-1].split(".")[0]) + 1 if names else 0
        writers = last["writers"] | ({writer: epoch} if epoch is not None else {})
        self.write_json(f"epochs/{nr:020d}.json", {"ends": ends, "writers": writers, "segments": placed})

    def remove(self, segments: list[dict]) -> None:
        from pyarrow import fs
        store, root = _store(self.path)
        for s in segments:
            if store.get_file_info(f"{root}/segments/{s['name']}").type == fs.FileType.File:
                store.delete_file(f"{root}/segments/{s['name']}")

    def between(self, start: dict, end: dict) -> list[Piece]:
        """The pieces of segments with offsets from ``start`` to below ``end`` per partition.

        Epochs are read from the newest back to the one that the start lies in.
        """
        found: list[Piece] = []
        for name in reversed(self.epochs()):
            if self._complete(found, start, end):
                break
            for s in self.read_json(f"epochs/{name}")["segments"]:
                p = str(s["partition"])
                low, high = max(s["first"], start.get(p, 0)), min(s["first"] + s["count"], end.get(p, 0))
                if low < high:
                    found.append(Piece(s["partition"], s["name"], s["first"], low, high))
        return sorted(found, key=lambda x: (x.partition, x.low))

    @staticmethod
    def _complete(found: list[Piece], start: dict, end: dict) -> bool:
        """Whether the pieces reach from start to end in every partition."""
        have: dict[str, int] = {}
        for x in found:
            have[str(x.partition)] = have.get(str(x.partition), 0) + x.high - x.low
        return all(have.get(p, 0) >= end[p] - start.get(p, 0) for p in end)


@dataclass
class Piece(InputPartition):
    """Offsets from ``low`` to below ``high`` of a segment that begins at ``first``."""
    partition: int
    name: str
    first: int
    low: int
    high: int


def _records(path: str, piece: Piece) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq
    store, root = _store(path)
    topic = root.rsplit("/", 1)[-1]
    table = pq.read_table(f"{root}/segments/{piece.name}", filesystem=store, schema=_RECORDS)
    part = table.slice(piece.low - piece.first, piece.high - piece.low)
    offset = piece.low
    for batch in part.to_batches(max_chunksize=10_000):
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([topic] * n, pa.string()), pa.array([piece.partition] * n, pa.int32()),
             pa.array(range(offset, offset + n), pa.int64()), batch.column(0), batch.column(1)],
            names=["topic", "partition", "offset", "key", "value"])
        offset += n


# ---- the source and the sink --------------------------------------------------------

class _BatchReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Piece]:
        log = LogFiles(self.path)
        return log.between({}, log.last()["ends"])

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        # A reader of an empty log is asked for a piece that is none.
        yield from _records(self.path, partition) if partition is not None else ()


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.starting = options.get("startingOffsets", "earliest")
        self.limit = int(options.get("maxRecordsPerTrigger", 0))
        self.group = options.get("group")
        if self.limit and not self.group:
            raise ValueError("maxRecordsPerTrigger needs a group, under which the newest plan is noted")
        self.log = LogFiles(self.path)
        self.offered = self.log.read_json(f"groups/{self.group}.json") if self.group else None

    def initialOffset(self) -> dict:
        if self.starting == "earliest":
            first = {}
        elif self.starting == "latest":
            first = dict(self.log.last()["ends"])
        else:
            first = {str(k): int(v) for k, v in json.loads(self.starting).items()}
        self.offered = first
        return first

    def latestOffset(self) -> dict:
        ends = self.log.last()["ends"]
        if not self.limit:
            return ends
        # The limit is dealt evenly over the partitions that have records waiting.
        at = dict(self.offered or {})
        left = self.limit
        waiting = sorted(p for p in ends if at.get(p, 0) < ends[p])
        for nr, p in enumerate(waiting):
            take = min(ends[p] - at.get(p, 0), -(-left // (len(waiting) - nr)))
            at[p] = at.get(p, 0) + take
            left -= take
        self.offered = at
        return at

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        if self.group:
            self.offered = end
            self.log.write_json(f"groups/{self.group}.json", end)
        return self.log.between(start, end)

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return _records(self.path, partition)


@dataclass
class _Written(WriterCommitMessage):
    segments: list


class _Writer:
    """Tasks write segments; the driver commits them as one epoch or removes them."""

    def __init__(self, options: dict):
        self.path, self.partitions = options["path"], int(options.get("partitions", PARTITIONS))
        self.writer = options.get("writer", "")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        return _Written(LogFiles(self.path).write_segments(iterator, self.partitions))

    def _commit(self, messages: list, epoch: int | None) -> None:
        LogFiles(self.path).commit([s for m in messages if m for s in m.segments], self.writer, epoch)

    def _abort(self, messages: list) -> None:
        LogFiles(self.path).remove([s for m in messages if m for s in m.segments])


class _BatchWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages: list) -> None:
        self._commit(messages, None)

    def abort(self, messages: list) -> None:
        self._abort(messages)


class _StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self._commit(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self._abort(messages)


class RecordLog(DataSource):
    """The ``record_log`` format."""

    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options)

    def _checked(self, schema) -> None:
        if not {"key", "value"} <= set(schema.fieldNames()):
            raise ValueError(f"a record has a key and a value, not {schema.fieldNames()}")

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        self._checked(schema)
        if overwrite:
            raise ValueError("a record log is appended to; it is never overwritten")
        return _BatchWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        self._checked(schema)
        if "writer" not in self.options:
            raise ValueError("a stream needs the option writer, a name by which its repeated epochs are known")
        return _StreamWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make ``record_log`` known to a session."""
    spark.dataSource.register(RecordLog)
