"""SRC-6: sample providers as a data source of their own.

``spark.dataSource.register(RecordedSamples)`` once; then
``spark.read.format("recorded_samples").load(folder)`` reads the samples that a
provider recorded as Parquet files (one row for each poll), and
``spark.readStream`` follows the folder as files arrive. Options: ``provider``
(its index, the tie-break of the merge order) and ``fields`` (the sample fields
it reports, comma separated; all by default), which also say what the rows
look like; fields that the files lack are 0, as the collector has them.

Each row group is one partition, read column by column as Arrow batches. A
provider of another kind subclasses ``RecordedSamples`` and overrides
``samples``, which turns a partition into record batches. A file or folder that
cannot be read fails the read; ``operators.samples.collect_providers`` then
skips that provider.
"""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from metricfold.schemas import CPU_FIELD, SAMPLE_FIELDS
from metricfold.sinks.observer import _file_system

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def recorded(path: str, provider: int, fields: list[str] | None = None):
    """A provider for ``operators.samples.collect_providers``: the samples
    recorded under ``path``."""
    def read(spark: SparkSession) -> DataFrame:
        spark.dataSource.register(RecordedSamples)
        r = spark.read.format("recorded_samples").option("provider", provider)
        if fields:
            r = r.option("fields", ",".join(fields))
        RecordedSamples({"path": path}).files()  # a folder that is not there fails here
        return r.load(path)
    return read


class RowGroup(InputPartition):
    def __init__(self, path: str, group: int):
        self.path, self.group = path, group


class RecordedSamples(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recorded_samples"

    def fields(self) -> list[str]:
        chosen = self.options.get("fields")
        names = [f.strip() for f in chosen.split(",")] if chosen else [*SAMPLE_FIELDS, CPU_FIELD]
        unknown = set(names) - {*SAMPLE_FIELDS, CPU_FIELD}
        if unknown:
            raise ValueError(f"no such sample fields: {sorted(unknown)}")
        return names

    def schema(self) -> str:
        kinds = [f"{f} {'array<double>' if f == CPU_FIELD else 'double'}" for f in self.fields()]
        return ", ".join([f"host {self.options.get('host_type', 'bigint')}", "ord bigint", "provider int",
                          "ts timestamp_ntz", *kinds])

    def reader(self, schema) -> DataSourceReader:
        return Recordings(self, schema.fieldNames())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FollowedRecordings(self, schema.fieldNames())

    def files(self) -> list[str]:
        """The folder's files, oldest first."""
        store, root = _file_system(self.options["path"])
        found = [f for f in store.get_file_info(fs.FileSelector(root, recursive=True))
                 if f.is_file and not f.base_name.startswith(("_", "."))]
        return [f.path for f in sorted(found, key=lambda f: (f.mtime_ns or 0, f.path))]

    def partitions(self, paths: list[str]) -> list[InputPartition]:
        store, _ = _file_system(self.options["path"])
        return [RowGroup(p, g) for p in paths for g in range(pq.ParquetFile(store.open_input_file(p)).num_row_groups)]

    def samples(self, part: RowGroup, names: list[str]):
        """Record batches of one partition, with the columns ``names``."""
        store, _ = _file_system(self.options["path"])
        file = pq.ParquetFile(store.open_input_file(part.path))
        held = set(file.schema_arrow.names)
        for batch in file.iter_batches(row_groups=[part.group], columns=[n for n in names if n in held]):
            yield self.conform(batch, names)

    def conform(self, batch: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
        kinds = {"ord": pa.int64(), "provider": pa.int32(), "ts": pa.timestamp("us"), CPU_FIELD: pa.list_(pa.float64())}
        held, out = set(batch.schema.names), []
        for n in names:
            kind = kinds.get(n, pa.float64()) if n != "host" else None
            if n == "provider":
                col = pa.array([int(self.options.get("provider", 0))] * batch.num_rows, kind)
            elif n in held:
                col = batch.column(n) if kind is None else batch.column(n).cast(kind)
            else:
                col = pa.array([[] if n == CPU_FIELD else 0.0 if n in SAMPLE_FIELDS else None] * batch.num_rows, kind)
            out.append(col)
        return pa.RecordBatch.from_arrays(out, names=names)


class Recordings(DataSourceReader):
    def __init__(self, source: RecordedSamples, names: list[str]):
        self.source, self.names = source, names

    def partitions(self):
        return self.source.partitions(self.source.files())

    def read(self, partition):
        yield from self.source.samples(partition, self.names)


class FollowedRecordings(DataSourceStreamReader):
    """Offsets count the files seen, oldest first; a recording folder only grows."""

    def __init__(self, source: RecordedSamples, names: list[str]):
        self.source, self.names = source, names

    def initialOffset(self) -> dict:
        return {"files": 0}

    def latestOffset(self) -> dict:
        return {"files": len(self.source.files())}

    def partitions(self, start: dict, end: dict):
        return self.source.partitions(self.source.files()[start["files"]:end["files"]])

    def read(self, partition):
        yield from self.source.samples(partition, self.names)

    def commit(self, end: dict) -> None:
        """Nothing to release: the files stay."""
