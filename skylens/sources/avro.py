"""SRC-9 / SRC-11: raw Avro container files as a Spark source, split at sync markers.

``spark.dataSource.register(AvroFiles)`` once, then ``spark.read.format("avro_files").load(folder)``. A file
is cut into byte ranges; a task looks for the first sync marker in its range and reads the blocks that
begin there, so a large file is read by many tasks and each block by exactly one. Files are reached
through Arrow's file systems (local, HDFS, S3). Besides the record's own fields a row has its ``_file``,
``_block`` (the byte after the marker before it) and ``_place`` in the block, which no split changes.

Only what a container needs is decoded here: null, deflate and zstandard blocks, and the types of the
schema language but for logical ones, which stay what they are stored as.
"""

from __future__ import annotations

import io
import json
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MAGIC = b"Obj\x01"
SPLIT_BYTES = 64 << 20
ROWS = 8192
_PLAIN = {"null": pa.null(), "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "float": pa.float32(), "double": pa.float64(),
          "bytes": pa.binary(), "string": pa.string()}
_SPARK = {pa.bool_(): "boolean", pa.int32(): "int", pa.int64(): "long", pa.float32(): "float", pa.float64(): "double", pa.binary(): "binary",
          pa.string(): "string"}
PLACE = [pa.field("_file", pa.string()), pa.field("_block", pa.int64()), pa.field("_place", pa.int64())]


class Damaged(ValueError):
    """The bytes are no Avro container, or end or break off inside one."""


def _exactly(stream, n: int) -> bytes:
    data = stream.read(n)
    if len(data) < n:
        raise Damaged("the file breaks off")
    return data


def read_long(stream) -> int:
    shift = value = 0
    while True:
        byte = _exactly(stream, 1)[0]
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1)
        shift += 7
        if shift > 63:
            raise Damaged("a number is too long")


def _blob(stream) -> bytes:
    return _exactly(stream, read_long(stream))


def _counted(stream, item: Callable) -> Iterator:
    """Items of an array or map, which come in counted runs."""
    while n := read_long(stream):
        if n < 0:
            n, _ = -n, read_long(stream)
        for _ in range(n):
            yield item(stream)


def reader_of(schema, named: dict | None = None) -> tuple[pa.DataType, Callable]:
    """(Arrow type, function that reads a value) of a schema."""
    named = {} if named is None else named
    if isinstance(schema, list):
        choices = [reader_of(s, named) for s in schema]
        kinds = [k for k, _ in choices if k != pa.null()]
        if len(kinds) > 1:
            raise Damaged("unions of several types aren't read")
        return (kinds or [pa.null()])[0], lambda s: choices[read_long(s)][1](s)
    if isinstance(schema, str):
        if schema in named:
            return named[schema]
        plain = {"null": lambda s: None, "boolean": lambda s: _exactly(s, 1) != b"\0", "int": read_long, "long": read_long,
                 "float": lambda s: struct.unpack("<f", _exactly(s, 4))[0], "double": lambda s: struct.unpack("<d", _exactly(s, 8))[0],
                 "bytes": _blob, "string": lambda s: _blob(s).decode()}
        if schema not in plain:
            raise Damaged(f"unknown type {schema}")
        return _PLAIN[schema], plain[schema]
    kind = schema["type"]
    if kind == "record":
        fields = [(f["name"], *reader_of(f["type"], named)) for f in schema["fields"]]
        found = pa.struct([pa.field(n, k) for n, k, _ in fields]), lambda s: {n: read(s) for n, _, read in fields}
    elif kind == "array":
        item, read = reader_of(schema["items"], named)
        return pa.list_(item), lambda s: list(_counted(s, read))
    elif kind == "map":
        item, read = reader_of(schema["values"], named)
        return pa.map_(pa.string(), item), lambda s: list(_counted(s, lambda t: (_blob(t).decode(), read(t))))
    elif kind == "enum":
        symbols = schema["symbols"]
        found = pa.string(), lambda s: symbols[read_long(s)]
    elif kind == "fixed":
        size = schema["size"]
        found = pa.binary(), lambda s: _exactly(s, size)
    else:
        return reader_of(kind, named)
    named[schema["name"]] = found
    return found


class Container:
    """An open container file: its header, and its blocks from a byte on."""

    def __init__(self, stream) -> None:
        self.stream = stream
        if stream.read(4) != MAGIC:
            raise Damaged("no Avro container")
        meta = dict(_counted(stream, lambda s: (_blob(s).decode(), _blob(s))))
        self.sync, self.first = _exactly(stream, 16), stream.tell()
        self.codec = meta.get("avro.codec", b"null").decode()
        self.schema = json.loads(meta["avro.schema"])
        if not isinstance(self.schema, dict) or self.schema.get("type") != "record":
            raise Damaged("the container's values are no records")
        self.type, self.read_record = reader_of(self.schema)

    def unpacked(self, data: bytes) -> bytes:
        if self.codec == "null":
            return data
        if self.codec == "deflate":
            return zlib.decompress(data, -15)
        if self.codec == "zstandard":
            import zstandard
            return zstandard.ZstdDecompressor().decompressobj().decompress(data)
        raise Damaged(f"blocks packed with {self.codec} aren't read")

    def seek_block(self, start: int) -> int | None:
        """The first block that begins at or after ``start``: behind the header, or behind a marker."""
        if start <= self.first:
            self.stream.seek(self.first)
            return self.first
        at = start - 16  # a marker that ends right at ``start`` counts
        self.stream.seek(at)
        held = b""
        while chunk := self.stream.read(1 << 16):
            held += chunk
            if (hit := held.find(self.sync)) >= 0:
                self.stream.seek(at + hit + 16)
                return at + hit + 16
            at, held = at + max(0, len(held) - 15), held[-15:]
        return None

    def blocks(self, start: int, end: int) -> Iterator[tuple[int, list[dict]]]:
        """(first byte, records) of the blocks that begin in [start, end)."""
        at = self.seek_block(start)
        while at is not None and at < end:
            if not self.stream.read(1):  # the end of the file
                return
            self.stream.seek(at)
            count, data = read_long(self.stream), _blob(self.stream)
            if _exactly(self.stream, 16) != self.sync:
                raise Damaged(f"no marker behind the block at {at}")
            body = io.BytesIO(self.unpacked(data))
            yield at, [self.read_record(body) for _ in range(count)]
            at = self.stream.tell()


def files_of(path: str) -> list[tuple[str, int]]:
    """(path, size) of the ``.avro`` files in a folder, or of one file."""
    store, place = arrow_fs.FileSystem.from_uri(path) if "://" in path else (arrow_fs.LocalFileSystem(), path)
    info = store.get_file_info(place)
    infos = [info] if info.is_file else store.get_file_info(arrow_fs.FileSelector(place, recursive=True))
    prefix = path.split("://")[0] + "://" if "://" in path and not path.startswith("file:") else ""
    return sorted((prefix + i.path, i.size) for i in infos if i.is_file and i.path.endswith(".avro"))


def opened(path: str):
    store, place = arrow_fs.FileSystem.from_uri(path) if "://" in path else (arrow_fs.LocalFileSystem(), path)
    return store.open_input_file(place)


def _spark_type(kind: pa.DataType) -> str:
    if pa.types.is_struct(kind):
        return "struct<" + ", ".join(f"`{f.name}`: {_spark_type(f.type)}" for f in kind) + ">"
    if pa.types.is_map(kind):
        return f"map<string, {_spark_type(kind.item_type)}>"
    if pa.types.is_list(kind):
        return f"array<{_spark_type(kind.value_type)}>"
    return _SPARK.get(kind, "string")


class Range(InputPartition):
    def __init__(self, file: str, start: int, end: int) -> None:
        super().__init__(None)
        self.file, self.start, self.end = file, start, end


class AvroFiles(DataSource):
    """``path``: a folder or file; ``splitBytes``: size of a task's byte range."""

    @classmethod
    def name(cls) -> str:
        return "avro_files"

    def schema(self) -> str:
        found = files_of(self.options["path"])
        if not found:
            raise FileNotFoundError(f"no Avro files in {self.options['path']}")
        with opened(found[0][0]) as stream:
            own = Container(stream).type
        return ", ".join(f"`{f.name}` {_spark_type(f.type)}" for f in [*own, *PLACE])

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.split = options["path"], int(options.get("splitBytes", SPLIT_BYTES))

    def partitions(self) -> list[Range]:
        return [Range(f, start, min(start + self.split, size)) for f, size in files_of(self.path) for start in range(0, max(size, 1), self.split)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        with opened(part.file) as stream:
            container = Container(stream)
            kind = pa.schema([*container.type, *PLACE])
            for at, records in container.blocks(part.start, part.end):
                for k in range(0, len(records), ROWS):
                    rows = [{**r, "_file": part.file, "_block": at, "_place": k + i} for i, r in enumerate(records[k:k + ROWS])]
                    yield pa.RecordBatch.from_pylist(rows, schema=kind)
