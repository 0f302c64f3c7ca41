"""One JSON file from a table, all of it or nothing: tasks write parts beside the target, the commit joins and renames them.

Until the rename the target stays as it was; a failed job leaves no part behind. A task that is run twice writes a part of
its own each time, and the commit takes the one that Spark counts. The driver copies bytes in blocks, it holds no rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

BLOCK = 1 << 20


def arrow_files(path: str):
    """Arrow's file system of a path, and the path in it."""
    from pyarrow import fs

    local = path.removeprefix("file:")
    return (fs.LocalFileSystem(), "/" + local.lstrip("/")) if local.startswith("/") else fs.FileSystem.from_uri(path)


@dataclass
class Part(WriterCommitMessage):
    place: int
    path: str
    rows: int


class SingleWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.path, self.head, self.tail = options["path"], options["head"], options["tail"]
        self.folder = f"{self.path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Part:
        files, folder = arrow_files(self.folder)
        files.create_dir(folder)
        place, rows = TaskContext.get().partitionId(), 0
        path = f"{folder}/{place:06d}-{uuid.uuid4().hex}"
        with files.open_output_stream(path) as out:
            for row in iterator:
                out.write((",\n" if rows else "").encode() + row[0].encode())
                rows += 1
        return Part(place, path, rows)

    def commit(self, messages: list[Part | None]) -> None:
        files, folder = arrow_files(self.folder)
        _, path = arrow_files(self.path)
        files.create_dir(folder)
        parts = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.place)
        with files.open_output_stream(f"{folder}/whole") as out:
            out.write(self.head.encode())
            for i, part in enumerate(parts):
                out.write(b",\n" if i else b"")
                with files.open_input_stream(part.path) as read:
                    while block := read.read(BLOCK):
                        out.write(block)
            out.write(self.tail.encode())
        files.move(f"{folder}/whole", path)
        files.delete_dir(folder)

    def abort(self, messages: list[Part | None]) -> None:
        files, folder = arrow_files(self.folder)
        if files.get_file_info(folder).type.name != "NotFound":
            files.delete_dir(folder)


class SingleFile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "single_json"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> SingleWriter:
        return SingleWriter(dict(self.options))


def _write(df: DataFrame, path: str, order: tuple[str, ...], head: str, tail: str) -> None:
    df.sparkSession.dataSource.register(SingleFile)
    rows = df.orderBy(*order) if order else df
    lines = rows.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"}).alias("value"))
    lines.write.format("single_json").mode("append").options(path=path, head=head, tail=tail).save()


def write_array(df: DataFrame, path: str, *order: str) -> None:
    """The rows as one JSON array, in order."""
    _write(df, path, order, "[", "]\n")


def write_object(row: DataFrame, path: str) -> None:
    """A table of one row as one JSON object."""
    _write(row.limit(1), path, (), "", "\n")


def write_manifest(df: DataFrame, path: str, *order: str, about: Mapping[str, object] = {}, rows: str = "records", counted: str | None = None) -> None:
    """One object: what is told about the rows, their number, their number by a column of few values, and the rows in order.

    The rows are read twice, once for the numbers; checkpoint what is costly.
    """
    told = dict(about)
    if counted:
        found = {r[0]: r[1] for r in df.groupBy(F.coalesce(F.col(counted), F.lit(""))).count().collect()}
        told |= {"total": sum(found.values()), f"counts_by_{counted}": dict(sorted(found.items()))}
    else:
        told |= {"total": df.count()}
    head = json.dumps(told, ensure_ascii=False)[:-1]
    _write(df, path, order, f"{head}, {json.dumps(rows)}: [", "]}\n")
