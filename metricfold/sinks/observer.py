"""SNK-5: audit observers as a data source of their own.

``spark.dataSource.register(AuditLines)`` once, then any stream of events
writes to the observer with ``writeStream.format("audit_lines")``. Each task
writes the JSON lines of its partition to a file of its own and reports it; the
driver's ``commit`` for the epoch gives the files their final names, after
taking away what an earlier attempt at the same epoch left. So a stream that is
killed after the lines were written, and repeats the epoch when restarted,
leaves each line once; ``abort`` deletes what the failed attempt wrote. Other
observers subclass ``AuditLines`` and override ``deliver``, which gets an
epoch's files.
"""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    path: str


class AuditLines(DataSource):
    """Options: ``path`` (a shared folder). Rows need a ``line`` column."""

    @classmethod
    def name(cls) -> str:
        return "audit_lines"

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return LineWriter(self.options["path"].rstrip("/"), schema.fieldNames().index("line"), self.deliver)

    @staticmethod
    def deliver(files: fs.FileSystem, root: str, epoch: int, written: list[str]) -> None:
        """Makes an epoch's files the observer's lines, replacing an earlier
        attempt's."""
        head = f"epoch-{epoch:012d}-"
        for old in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if old.base_name.startswith(head):
                files.delete_file(old.path)
        for k, path in enumerate(sorted(written)):
            files.move(path, f"{root}/{head}{k:05d}.jsonl")


class LineWriter(DataSourceStreamWriter):
    def __init__(self, path: str, column: int, deliver):
        self.path, self.column, self.deliver = path, column, deliver

    def write(self, iterator) -> Written:
        files, root = _file_system(self.path)
        files.create_dir(f"{root}/_staged", recursive=True)
        path = f"{root}/_staged/{uuid.uuid4().hex}"
        with files.open_output_stream(path) as out:
            for row in iterator:
                out.write(row[self.column].encode() + b"\n")
        return Written(path)

    def commit(self, messages, batchId: int) -> None:
        files, root = _file_system(self.path)
        self.deliver(files, root, batchId, [m.path for m in messages if m is not None])

    def abort(self, messages, batchId: int) -> None:
        files, _ = _file_system(self.path)
        for m in messages:
            if m is not None and files.get_file_info(m.path).is_file:
                files.delete_file(m.path)
