"""Large files row by row: elements of a JSON list, rows of an XML document, entries of ZIP archives.

A file of these kinds cannot be cut, so that one task reads it, but no task holds it: it is read block by block, and a batch
of rows goes to Spark as soon as it has some bytes. A task's memory is one block, one batch and the longest row.
"""

from __future__ import annotations

import codecs
import fnmatch
import json
import re
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO
from zipfile import BadZipFile, ZipFile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .single import arrow_files

BLOCK = 1 << 20
ROWS = "path string, pos int, value string"
ENTRY = "path string, entry_pos int, filename string, size long, content binary, error string"
ENTRIES = pa.schema([("path", pa.string()), ("entry_pos", pa.int32()), ("filename", pa.string()), ("size", pa.int64()), ("content", pa.binary()), ("error", pa.string())])
VALUES = pa.schema([("path", pa.string()), ("pos", pa.int32()), ("value", pa.string())])
#: What an archive that cannot be read may raise.
UNREADABLE = (BadZipFile, zlib.error, EOFError, OSError, NotImplementedError, RuntimeError, ValueError)
Read = Callable[[int], bytes]
_SPACE = re.compile(r"[ \t\r\n]*")


class _Text:
    """JSON text that is read as far as it is looked at."""

    def __init__(self, read: Read, block: int):
        self.read, self.block, self.text, self.at, self.ended = read, block, "", 0, False
        self.decoder = codecs.getincrementaldecoder("utf-8-sig")()
        self.parse = json.JSONDecoder().raw_decode

    def more(self) -> None:
        # As much again as is still open: a long value is begun anew a few times only.
        data = self.read(max(self.block, len(self.text) - self.at))
        self.text, self.at, self.ended = self.text[self.at :] + self.decoder.decode(data, final=not data), 0, not data

    def peek(self) -> str:
        """The next character that is no white space; empty at the end."""
        while True:
            self.at = _SPACE.match(self.text, self.at).end()
            if self.at < len(self.text) or self.ended:
                return self.text[self.at : self.at + 1]
            self.more()

    def take(self, wanted: str) -> str:
        found = self.peek()
        if not found or found not in wanted:
            raise ValueError(f"{found or 'the end'} in place of one of {wanted}")
        self.at += 1
        return found

    def value(self) -> str:
        """The text of the next value."""
        self.peek()
        while True:
            try:
                end = self.parse(self.text, self.at)[1]
                # What a number may go on with is not its end yet.
                if self.ended or self.text[end : end + 1] in tuple(" \t\r\n,]}:"):
                    found, self.at = self.text[self.at : end], end
                    return found
            except json.JSONDecodeError:
                if self.ended:
                    raise
            self.more()

    def items(self) -> Iterator[str]:
        self.take("[")
        if self.peek() == "]":
            self.at += 1
            return
        while True:
            yield self.value()
            if self.take(",]") == "]":
                return


def split_json(read: Read, field: str = "", block: int = BLOCK) -> Iterator[str]:
    """The texts of the elements of a JSON list: the file's own, or the list under a key of the file's object.

    A file that is torn, that is of another kind, or that has no such list or two, is a ValueError when that is met.
    """
    text, found = _Text(read, block), not field
    if not field:
        yield from text.items()
    elif text.take("{") and text.peek() == "}":
        text.at += 1
    else:
        while True:
            key = json.loads(text.value())
            text.take(":")
            if key != field:
                text.value()
            elif found or text.peek() != "[":
                raise ValueError(f"no single list of {field}")
            else:
                found = True
                yield from text.items()
            if text.take(",}") == "}":
                break
    if not found:
        raise ValueError(f"no list of {field}")
    if text.peek():
        raise ValueError("text after the end")


def split_xml(read: Read, tag: str, block: int = BLOCK) -> Iterator[str]:
    """The texts of the elements with a name, which do not hold each other, from start tag to end tag."""
    name = re.escape(tag.encode())
    whole, start = re.compile(rb"<" + name + rb"(?:\s[^>]*)?>.*?</" + name + rb"\s*>", re.DOTALL), re.compile(rb"<" + name + rb"[\s>]")
    data, encoding = read(block), "utf-8"
    if said := re.match(rb"(?:\xef\xbb\xbf)?\s*<\?xml[^>]*encoding\s*=\s*[\"']([A-Za-z0-9._-]+)", data):
        encoding = said[1].decode()
    while data:
        at = 0
        for found in whole.finditer(data):
            yield found[0].decode(encoding)
            at = found.end()
        open_at = start.search(data, at)
        rest = data[open_at.start() if open_at else max(at, len(data) - len(tag) - 1) :]
        more = read(max(block, len(rest)))
        if not more:
            return
        data = rest + more


def archive_entries(path: str, file: BinaryIO) -> Iterator[tuple]:
    """Rows of ``ENTRY`` of an archive's XML files, read one by one.

    An archive of which any entry cannot be read is one row with an error and no other: all are read through in blocks before
    the first is given. A body that is JSON in place of an archive is the error ``json``, its message in ``filename``.
    """
    try:
        if file.read(BLOCK).lstrip()[:1] == b"{":
            file.seek(0)
            yield path, None, str(json.loads(file.read()).get("message", "")), None, None, "json"
            return
        file.seek(0)
        with ZipFile(file) as archive:
            entries = [i for i in archive.infolist() if not i.is_dir() and i.filename.lower().endswith(".xml")]
            for info in entries:
                with archive.open(info) as part:
                    while part.read(BLOCK):
                        pass
            for pos, info in enumerate(entries):
                yield path, pos, info.filename, info.file_size, archive.read(info), None
    except UNREADABLE as e:
        yield path, None, None, None, None, type(e).__name__


def archive_rows(file: BinaryIO, tag: str) -> Iterator[str]:
    """The XML rows of an archive's first XML file; none where it has none."""
    with ZipFile(file) as archive:
        first = next((i for i in archive.infolist() if not i.is_dir() and i.filename.lower().endswith(".xml")), None)
        if first is not None:
            with archive.open(first) as part:
                yield from split_xml(part.read, tag)


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """Rows in batches that are closed when their texts have ``size`` bytes or characters."""
    held, room = [], size
    for row in rows:
        held.append(row)
        room -= 64 + sum(len(x) for x in row if isinstance(x, (str, bytes)))
        if room <= 0:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)
            held, room = [], size
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), schema)], schema=schema)


def _found(path: str, glob: str) -> list[str]:
    """The paths of a file, or of the files below a folder whose names fit."""
    from pyarrow.fs import FileSelector, FileType

    files, place = arrow_files(path)
    about = files.get_file_info(place)
    if about.type == FileType.NotFound:
        raise ValueError(f"{path}: not found")
    full = lambda p: f"file:{p}" if path.startswith(("/", "file:")) else path.removesuffix("/")[: len(path.removesuffix("/")) - len(place)] + p
    if about.type == FileType.File:
        return [full(place)]
    inside = files.get_file_info(FileSelector(place, recursive=True))
    return sorted(full(i.path) for i in inside if i.type == FileType.File and fnmatch.fnmatch(i.base_name, glob))


class _Seekable:
    """An Arrow file as the archive reader takes it: a place before the start is an OSError."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.read, self.tell = file, file.read, file.tell

    def seekable(self) -> bool:
        return True

    def seek(self, place: int, whence: int = 0) -> int:
        try:
            return self.file.seek(place, whence)
        except pa.ArrowInvalid as e:
            raise OSError(str(e)) from e


class FilePartition(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ElementReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[FilePartition]:
        return [FilePartition(p) for p in _found(self.options["path"], self.options["glob"])] or [FilePartition("")]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        files, place = arrow_files(partition.path)
        kind, of = self.options["kind"], self.options["of"]
        with files.open_input_file(place) as file:
            if kind == "entries":
                yield from batches(archive_entries(partition.path, _Seekable(file)), ENTRIES)
                return
            rows = {"json": lambda: split_json(file.read, of), "xml": lambda: split_xml(file.read, of), "zip": lambda: archive_rows(_Seekable(file), of)}[kind]()
            try:
                yield from batches(((partition.path, pos, value) for pos, value in enumerate(rows)), VALUES)
            except UNREADABLE as e:
                raise ValueError(f"{partition.path}: {e}") from e


class ElementSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_elements"

    def schema(self) -> str:
        return ENTRY if self.options["kind"] == "entries" else ROWS

    def reader(self, schema) -> ElementReader:
        return ElementReader(dict(self.options))


def _read(spark: SparkSession, path: str, kind: str, of: str, glob: str) -> DataFrame:
    spark.dataSource.register(ElementSource)
    return spark.read.format("file_elements").options(path=path, kind=kind, of=of, glob=glob).load()


def json_elements(spark: SparkSession, path: str, field: str = "", glob: str = "*.json") -> DataFrame:
    """(path, pos, value) of the elements of a file's list, or of the lists in a folder's files."""
    return _read(spark, path, "json", field, glob)


def xml_rows(spark: SparkSession, path: str, tag: str, glob: str = "*.xml") -> DataFrame:
    return _read(spark, path, "xml", tag, glob)


def zip_rows(spark: SparkSession, path: str, tag: str, glob: str = "*.zip") -> DataFrame:
    """(path, pos, value) of the rows of each archive's first XML file."""
    return _read(spark, path, "zip", tag, glob)


def zip_entries(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    return _read(spark, path, "entries", "", glob)
