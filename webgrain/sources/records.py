"""Archive files of records: a source that seeks, and a sink that gives the index.

An index (Parquet) names for every record its file, offset and length. ``read_records`` reads the
records of an index as a data source: filters on the index reach its row groups, a task takes a run of
index rows and reads only their byte ranges from the archive files. So files may have any length, and
neither a file nor its list of ranges is ever held in a row.
"""

import posixpath
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from webgrain.plans.scale import fresh_path, materialize

PAYLOAD = "payload"
ROWS_PER_TASK = 50_000
GAP = 64 << 10  # ranges this close are read at once
SPAN = 8 << 20  # longest read that joins several ranges
BATCH = 32 << 20  # bytes of payload in a batch, or one record where it is longer


def _place(path: str):
    """(file system, path) of a local path or a URI."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _condition(f: D.Filter):
    """The filter as an Arrow expression; None where it has none that means the same."""
    if len(getattr(f, "attribute", ())) != 1 or f.attribute[0] == PAYLOAD:
        return None
    field = ds.field(f.attribute[0])
    match f:
        case D.EqualTo(value=v) if v is not None:
            return field == v
        case D.In(value=v) if all(x is not None for x in v):
            return field.isin(list(v))
        case D.GreaterThan(value=v):
            return field > v
        case D.GreaterThanOrEqual(value=v):
            return field >= v
        case D.LessThan(value=v):
            return field < v
        case D.LessThanOrEqual(value=v):
            return field <= v
        case D.IsNotNull():
            return field.is_valid()
        case D.StringStartsWith(value=v) if v:
            # the range lets row groups be skipped by their least and greatest values
            return (field >= v) & pa.compute.starts_with(field, v)
    return None


@dataclass
class IndexRun(D.InputPartition):
    """Rows ``first`` to ``end`` of one row group of an index file."""

    path: str
    group: int
    first: int
    end: int
    partition: bytes


class _Reader(D.DataSourceReader):
    def __init__(self, options, schema: StructType):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.index, self.root = options["index"], options["root"]
        self.rows = int(options.get("rowsPerTask", ROWS_PER_TASK))
        self.schema = to_arrow_schema(schema)
        self.pushed = []

    def pushFilters(self, filters):
        for f in filters:
            if _condition(f) is None:
                yield f
            else:
                self.pushed.append(f)

    def _condition(self):
        found = None
        for f in self.pushed:
            found = _condition(f) if found is None else found & _condition(f)
        return found

    def _partitioning(self):
        """Partition columns have the types of the schema, not guessed ones."""
        return ds.HivePartitioning(pa.schema([f for f in self.schema if f.name != PAYLOAD]))

    def partitions(self):
        # the driver sees names, partitions and row group statistics of the index, no row of it
        system, path = _place(self.index)
        table = ds.dataset(path, schema=self.schema, filesystem=system, format="parquet", partitioning=self._partitioning())
        runs = []
        condition = self._condition()
        for file in table.get_fragments(condition):
            known = file.partition_expression
            for part in file.split_by_row_group(condition, schema=self.schema):
                for group in part.row_groups:
                    for first in range(0, group.num_rows, self.rows):
                        runs.append(IndexRun(part.path, group.id, first, min(first + self.rows, group.num_rows),
                                             _partition_values(known, self.schema)))
        return runs or [IndexRun("", 0, 0, 0, b"")]

    def read(self, run):
        if not run.path:
            return
        rows = self._index_rows(run)
        if not rows.num_rows:
            return
        offsets, lengths = (_whole(rows.column(c)) for c in ("offset", "length"))
        names = rows.column("filename").to_pylist()
        order = sorted(range(rows.num_rows), key=lambda i: (names[i] or "", offsets[i]))
        batch, held = [], 0
        for i, payload in _ranges(self.root, names, offsets, lengths, order):
            batch.append((i, payload))
            held += len(payload or b"")
            if held >= BATCH or len(batch) >= 10_000:
                yield self._batch(rows, batch)
                batch, held = [], 0
        if batch:
            yield self._batch(rows, batch)

    def _index_rows(self, run) -> pa.Table:
        import pickle

        import pyarrow.parquet as pq

        system, _ = _place(self.index)
        fixed = pickle.loads(run.partition)
        wanted = [f for f in self.schema if f.name != PAYLOAD]
        with system.open_input_file(run.path) as source:
            file = pq.ParquetFile(source)
            there = set(file.schema_arrow.names)
            rows = file.read_row_group(run.group, columns=[f.name for f in wanted if f.name in there])
            rows = rows.slice(run.first, run.end - run.first)
        n = rows.num_rows
        columns = [rows.column(f.name).cast(f.type) if f.name in there else
                   pa.array([fixed.get(f.name)] * n, f.type) for f in wanted]
        rows = pa.table(columns, schema=pa.schema(wanted))
        condition = self._condition()
        return rows if condition is None else rows.filter(condition)

    def _batch(self, rows, batch):
        chosen = rows.take(pa.array([i for i, _ in batch], pa.int64())).combine_chunks()
        payload = pa.array([p for _, p in batch], self.schema.field(PAYLOAD).type)
        columns = [payload if f.name == PAYLOAD else chosen.column(f.name) for f in self.schema]
        return pa.Table.from_arrays(columns, schema=self.schema).combine_chunks().to_batches()[0]


def _partition_values(expression, schema) -> bytes:
    import pickle

    return pickle.dumps(ds.get_partition_keys(expression))


def _whole(column) -> list[int]:
    """Numbers or their text as integers; -1 for what is no place in a file."""
    def one(v):
        try:
            return max(int(v), -1)
        except (TypeError, ValueError):
            return -1

    return [one(v) for v in column.to_pylist()]


def _ranges(root, names, offsets, lengths, order):
    """(row, bytes) of the rows in ``order``, that is by file and offset. Neighbouring ranges are read at
    once. None for a file that does not exist and for a range that is none or not wholly inside its file;
    other errors of the file system fail the task, which then runs again."""
    system, base = _place(root)
    at = 0
    while at < len(order):
        name, end = names[order[at]], at
        while end < len(order) and names[order[end]] == name:
            end += 1
        mine, at = order[at:end], end
        try:
            file = system.open_input_file(posixpath.join(base, name)) if name else None
        except FileNotFoundError:
            file = None
        if file is None:
            yield from ((i, None) for i in mine)
            continue
        with file:
            size, k = file.size(), 0
            while k < len(mine):
                i = mine[k]
                if offsets[i] < 0 or lengths[i] < 0 or offsets[i] + lengths[i] > size:
                    yield i, None
                    k += 1
                    continue
                start, stop, last = offsets[i], offsets[i] + lengths[i], k + 1
                while last < len(mine) and 0 <= lengths[mine[last]] and offsets[mine[last]] <= stop + GAP:
                    reach = max(stop, offsets[mine[last]] + lengths[mine[last]])
                    if reach > size or reach - start > SPAN:
                        break
                    stop, last = reach, last + 1
                data = file.read_at(stop - start, start)
                for j in mine[k:last]:
                    yield j, data[offsets[j] - start:offsets[j] - start + lengths[j]]
                k = last


class CaptureRecords(D.DataSource):
    """``spark.read.format("capture_records")`` with the options ``index``, ``root`` and ``rowsPerTask``; the schema
    is that of the index (with ``filename``, ``offset``, ``length``) and ``payload binary``."""

    @classmethod
    def name(cls):
        return "capture_records"

    def reader(self, schema):
        return _Reader(self.options, schema)


def read_records(spark: SparkSession, index: str, root: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The columns of the index (Parquet folder, may have partition columns) and the bytes of each record,
    ``payload``. Filters on the index are applied before any record is read. Null payload: no such file, or a
    range that is not inside it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CaptureRecords)
    fields = spark.read.parquet(index).schema.fields
    schema = StructType([*fields, StructField(PAYLOAD, BinaryType())])
    return (spark.read.format("capture_records").schema(schema).option("index", index).option("root", root)
            .option("rowsPerTask", str(rows_per_task)).load())


def fetch_records(wanted: DataFrame, root: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``wanted`` (filename, offset, length and any others) with the bytes of each record. The rows are written
    as an index in the order of their places, so that a task reads one stretch of few files."""
    path = fresh_path(wanted.sparkSession, "wanted")
    place = ["filename", F.col("offset").try_cast("bigint")]
    wanted.repartitionByRange(*place).sortWithinPartitions(*place).write.parquet(path)
    return read_records(wanted.sparkSession, path, root, rows_per_task)


def write_records(df: DataFrame, root: str, file: str, order: str, payload: str = PAYLOAD) -> DataFrame:
    """Write the bytes of ``payload`` one behind the other into the files named by ``file`` below ``root``, by
    ``order``; gives the index: the other columns, ``filename``, ``offset``, ``length``. Null payloads have length 0.

    A file is written by one task, record by record, under a name of the attempt, and then renamed, so that a
    task that runs again or twice leaves the same file. The task of a file holds one batch of it.
    """
    others = [f for f in df.schema if f.name not in (payload, file, "offset", "length", "filename")]
    rows = df.select(F.col(file).cast("string").alias("filename"), F.col(payload).cast("binary").alias(payload),
                     *[f.name for f in others])
    schema = StructType([*others, StructField("filename", rows.schema["filename"].dataType),
                         StructField("offset", LongType()), StructField("length", LongType())])

    def run(batches):
        import uuid

        system, base = _place(root)
        system.create_dir(base, recursive=True)
        name, out, at, draft = None, None, 0, None

        def close():
            if out is not None:
                out.close()
                system.move(draft, posixpath.join(base, name))

        for batch in batches:
            names = batch.column(0).to_pylist()
            offsets, lengths = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
            for i, (file_name, record) in enumerate(zip(names, batch.column(1))):
                if file_name != name:
                    close()
                    name, at = file_name, 0
                    draft = posixpath.join(base, f"_{file_name}.{uuid.uuid4().hex}")
                    out = system.open_output_stream(draft)
                data = record.as_py() or b""
                out.write(data)
                offsets[i], lengths[i] = at, len(data)
                at += len(data)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], batch.column(0), pa.array(offsets), pa.array(lengths)], names=schema.names)
        close()

    grouped = rows.filter("filename is not null").repartition("filename").sortWithinPartitions("filename", order)
    return materialize(grouped.mapInArrow(run, schema), "index")
