"""Byte objects in files, read as ranges of bytes.

Spark's own source for binary files makes one row of a file, which ends at 2 GB and keeps a
large object in one task. Here a partition is a list of byte ranges: a large object is
read by many tasks, many small ones by one, and no row is longer than a chunk. Only names
and sizes are looked up on the driver, as for any file source.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from ..files import filesystem

#: Bytes of a chunk, and those that one partition is made for.
CHUNK_BYTES, PARTITION_BYTES = 4 << 20, 128 << 20
#: The first group of this in a file's name, without folder, is the object's id.
ID_PATTERN = r"(\d+)"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

COLUMNS = "object_id long, chunk_no long, offset long, length long, data binary"


@dataclass(frozen=True)
class Piece:
    """Some of the bytes of an object: from ``begin`` to ``stop`` in a file."""

    object_id: int
    file: str
    begin: int
    stop: int
    offset: int  # of ``begin`` in the object
    chunk_no: int  # of the first chunk


@dataclass
class Pieces(InputPartition):
    """What one task reads, in order."""

    pieces: list[Piece]

    def __init__(self, pieces: list[Piece]):
        self.pieces = pieces


def object_files(path: str, pattern: str) -> Iterator[tuple[int, str, int]]:
    """Id, file and size of the objects under a folder; hidden and unnamed files aren't any."""
    files, place = filesystem(path)
    name = re.compile(pattern)
    for found in files.get_file_info(arrow_fs.FileSelector(place, recursive=True)):
        if found.type == arrow_fs.FileType.File and found.base_name[0] not in "._":
            match = name.search(found.base_name)
            if match:
                yield int(match[1]), found.path, found.size


def cut_pieces(files: Iterable[tuple[int, str, int]], chunk: int, most: int, start: int) -> Iterator[Piece]:
    """Files of each object, in order, as pieces of whole chunks.

    Bytes of an object before ``start`` are left out, and chunks keep their numbers.
    """
    current, offset, number = None, 0, 0
    step = max(chunk, most // chunk * chunk)
    for object_id, file, size in files:
        if object_id != current:
            current, offset, number = object_id, 0, 0
        for begin in range(0, size, step):
            stop = min(size, begin + step)
            first = max(begin, min(stop, start - offset))
            first_chunk = number + first // chunk
            if first < stop:
                yield Piece(object_id, file, first, stop, offset + first, first_chunk)
        offset, number = offset + size, number + -(-size // chunk)


def dealt(pieces: Iterable[Piece], most: int) -> Iterator[Pieces]:
    """Neighbouring pieces together until they have ``most`` bytes."""
    some: list[Piece] = []
    size = 0
    for piece in pieces:
        if some and size + piece.stop - piece.begin > most:
            yield Pieces(some)
            some, size = [], 0
        some.append(piece)
        size += piece.stop - piece.begin
    if some:
        yield Pieces(some)


class ByteRanges(DataSourceReader):
    """Plans and reads the ranges of all or of the wanted objects."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.pattern = options.get("idPattern", ID_PATTERN)
        self.chunk = int(options.get("chunkBytes", CHUNK_BYTES))
        self.most = int(options.get("partitionBytes", PARTITION_BYTES))
        self.start = int(options.get("start", 0))
        self.wanted = [lambda i, ids={int(x) for x in options["ids"].split(",") if x}: i in ids] if "ids" in options else []
        if self.chunk < 1 or self.start < 0:
            raise ValueError("chunkBytes must be positive, start not negative")

    def files(self) -> list[tuple[int, str, int]]:
        found = sorted(f for f in object_files(self.path, self.pattern) if all(keep(f[0]) for keep in self.wanted))
        for (a, one, _), (b, other, _) in zip(found, found[1:]):
            if a == b:
                raise ValueError(f"two files of object {a}: {one}, {other}")
        return found

    def partitions(self) -> Sequence[InputPartition]:
        return list(dealt(cut_pieces(self.files(), self.chunk, self.most, self.start), self.most))

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        files, _ = filesystem(self.path)
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        for piece in partition.pieces:
            with files.open_input_file(piece.file) as source:
                at, number = piece.begin, piece.chunk_no
                while at < piece.stop:
                    size = min(piece.stop, at // self.chunk * self.chunk + self.chunk) - at
                    data = source.read_at(size, at)
                    if len(data) < size:
                        raise OSError(f"{piece.file} is shorter than it was")
                    place = piece.offset + at - piece.begin
                    columns = [[piece.object_id], [number], [place], [size], [data]]
                    kinds = [pa.int64()] * 4 + [pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
                    at, number = at + size, number + 1


class PrunedRanges(ByteRanges):
    """Takes filters on the object's id, so that the other files are never opened."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if getattr(f, "attribute", None) != ("object_id",):
                yield f
            elif isinstance(f, EqualTo):
                self.wanted.append(lambda i, v=f.value: i == v)
            elif isinstance(f, In):
                self.wanted.append(lambda i, v=set(f.value): i in v)
            elif isinstance(f, GreaterThan):
                self.wanted.append(lambda i, v=f.value: i > v)
            elif isinstance(f, GreaterThanOrEqual):
                self.wanted.append(lambda i, v=f.value: i >= v)
            elif isinstance(f, LessThan):
                self.wanted.append(lambda i, v=f.value: i < v)
            elif isinstance(f, LessThanOrEqual):
                self.wanted.append(lambda i, v=f.value: i <= v)
            elif not isinstance(f, IsNotNull):
                yield f


class ObjectFiles(DataSource):
    """The source ``chainlake_objects``."""

    @classmethod
    def name(cls) -> str:
        return "chainlake_objects"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> DataSourceReader:
        return (PrunedRanges if self.options.get("pushFilters") == "true" else ByteRanges)(self.options)


def read_objects(
    spark: SparkSession,
    path: str,
    chunk_bytes: int = CHUNK_BYTES,
    ids: Iterable[int] | None = None,
    start: int = 0,
    id_pattern: str = ID_PATTERN,
    partition_bytes: int = PARTITION_BYTES,
) -> DataFrame:
    """``object_id, chunk_no, offset, length, data`` of the files under ``path``.

    A file is an object; its id is the first group of ``id_pattern`` in the file's name. No row
    is longer than ``chunk_bytes``. ``start`` leaves out the bytes before it, to go on
    where an earlier read ended. ``ids`` picks objects, and so do filters on
    ``object_id`` where ``spark.sql.python.filterPushdown.enabled`` is set, as
    :func:`chainlake.get_session` does. Offsets are given, so that
    :func:`~chainlake.operators.objects.rechunk` shuffles the bytes once. Empty objects have no
    rows; :func:`list_objects` has them.
    """
    spark.dataSource.register(ObjectFiles)
    options = {"chunkBytes": chunk_bytes, "start": start, "idPattern": id_pattern, "partitionBytes": partition_bytes}
    if ids is not None:
        options["ids"] = ",".join(map(str, ids))
    if spark.conf.get(PUSHDOWN, "false") == "true":
        options["pushFilters"] = "true"
    return spark.read.format(ObjectFiles.name()).options(**options).load(path)


def list_objects(spark: SparkSession, path: str, id_pattern: str = ID_PATTERN) -> DataFrame:
    """``object_id, size, path`` of the files under ``path``, empty ones too; no bytes are read.

    As any listing of files, this is done by the driver.
    """
    found = [(number, size, file) for number, file, size in object_files(path, id_pattern)]
    return spark.createDataFrame(found, "object_id long, size long, path string")
