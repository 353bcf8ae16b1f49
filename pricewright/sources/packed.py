"""Folders of small files packed into a few archives: a data source for reading and writing them.

A folder of millions of documents costs a listing entry, an open and a task's share
each. Packed, the documents are members of tar archives of about ``PACK_BYTES``,
written by tasks next to a list of what was written. The list appears only when the
whole write has succeeded, so archives of a failed or repeated task are never read.

    files.select("source", "content").write.format("packed_files").mode("append").save(path)
    spark.read.format("packed_files").load(path)

Columns are ``source`` (the path of a document inside the folder) and ``content`` (its
bytes). Asked for ``source`` alone (a schema without ``content``), a reader steps from
header to header and leaves the contents where they are. A partition is a run of
archives of about ``split`` bytes. A folder without lists is one that other tools
have packed: all its archives are read.
"""

from __future__ import annotations

import io
import json
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "packed_files"
PACK_BYTES = 64 << 20
SPLIT_BYTES = 128 << 20
BATCH_BYTES = 4 << 20
_LIST = "_packs-"
_FIELDS = {"source": pa.string(), "content": pa.binary()}


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path on it."""
    if "://" in path or path.startswith("file:"):
        system, inner = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/")
                                               and not path.startswith("file://") else path)
        return system, inner.rstrip("/")
    return fs.LocalFileSystem(), path.rstrip("/")


@dataclass
class Packs(InputPartition):
    """The archives one task reads."""

    names: tuple[str, ...]

    def __init__(self, names: tuple[str, ...]):
        super().__init__(names)
        self.names = names


@dataclass
class Written(WriterCommitMessage):
    """Archives of one task with their sizes."""

    packs: list[tuple[str, int]]


def members(system: fs.FileSystem, pack: str, contents: bool) -> Iterator[tuple[str, bytes | None]]:
    """Every file of an archive in order; without ``contents`` only headers are read."""
    with system.open_input_file(pack) as file, tarfile.open(fileobj=file, mode="r:") as archive:
        for member in archive:
            if member.isfile():
                yield member.name, archive.extractfile(member).read() if contents else None
            archive.members = []  # a read member is not needed again


class _Reader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], split: int):
        self.path, self.columns, self.split = path, columns, split

    def partitions(self) -> list[Packs]:
        system, folder = _opened(self.path)
        files = system.get_file_info(fs.FileSelector(folder, recursive=True))
        lists = [file.path for file in files if file.base_name.startswith(_LIST)]
        sizes = [(file.path, file.size) for file in files if file.base_name.endswith(".tar")]
        if lists:
            committed = set()
            for name in lists:
                with system.open_input_file(name) as file:
                    committed.update(json.loads(file.read()))
            sizes = [(path, size) for path, size in sizes if path.rsplit("/", 1)[-1] in committed]
        runs: list[list[str]] = []
        room = 0
        for path, size in sorted(sizes):
            if not runs or size > room:
                runs.append([])
                room = self.split
            runs[-1].append(path)
            room -= size
        return [Packs(tuple(run)) for run in runs]

    def read(self, partition: Packs) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a folder without archives
            return
        system, _ = _opened(self.path)
        schema = pa.schema([(name, _FIELDS[name]) for name in self.columns])
        rows: list[tuple] = []
        size = 0
        for pack in partition.names:
            for name, content in members(system, pack, "content" in self.columns):
                rows.append((name, content))
                size += len(name) + len(content or b"")
                if size >= BATCH_BYTES:
                    yield self._batch(rows, schema)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows, schema)

    def _batch(self, rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        places = [list(_FIELDS).index(name) for name in self.columns]
        return pa.RecordBatch.from_arrays(
            [pa.array([row[place] for row in rows], field.type) for place, field in zip(places, schema, strict=True)],
            schema=schema)


class _Pack:
    """An archive that is being written."""

    def __init__(self, system: fs.FileSystem, folder: str):
        self.name, self.size = f"part-{uuid.uuid4().hex}.tar", 0
        self._file = system.open_output_stream(f"{folder}/{self.name}")
        self._archive = tarfile.open(fileobj=self._file, mode="w|", format=tarfile.PAX_FORMAT)

    def add(self, source: str, content: bytes) -> None:
        header = tarfile.TarInfo(source)
        header.size = len(content)
        self._archive.addfile(header, io.BytesIO(content))
        self.size += len(content) + 512

    def close(self) -> tuple[str, int]:
        self._archive.close()
        self._file.close()
        return self.name, self.size


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, pack_bytes: int):
        self.path, self.pack_bytes = path, pack_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = _opened(self.path)
        system.create_dir(folder, recursive=True)
        done: list[tuple[str, int]] = []
        pack: _Pack | None = None
        for batch in iterator:
            for source, content in zip(batch.column("source").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if source is None or source == "":
                    raise ValueError("a packed document needs a source")
                pack = pack or _Pack(system, folder)
                pack.add(source, content or b"")
                if pack.size >= self.pack_bytes:
                    done.append(pack.close())
                    pack = None
        if pack:
            done.append(pack.close())
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = _opened(self.path)
        names = [name for message in messages if message for name, _ in message.packs]
        system.create_dir(folder, recursive=True)
        with system.open_output_stream(f"{folder}/{_LIST}{uuid.uuid4().hex}.json") as file:
            file.write(json.dumps(names).encode())


class PackedFiles(DataSource):
    """Options: ``path``; reading, ``split`` bytes a partition; writing, ``pack`` bytes an archive."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "source string, content binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        unknown = set(schema.names) - set(_FIELDS)
        if unknown:
            raise ValueError(f"packed files have no columns {sorted(unknown)}")
        return _Reader(self.options["path"], schema.names, int(self.options.get("split", SPLIT_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("packed files are only added to")
        if set(schema.names) != set(_FIELDS):
            raise ValueError("packed files are written from the columns source and content")
        return _Writer(self.options["path"], int(self.options.get("pack", PACK_BYTES)))


def packed(spark: SparkSession, path: str, contents: bool = True, split: int = SPLIT_BYTES) -> DataFrame:
    """``source`` and, unless left out, ``content`` of every document of a packed folder."""
    spark.dataSource.register(PackedFiles)
    columns = "source string, content binary" if contents else "source string"
    return spark.read.format(FORMAT).schema(columns).option("split", split).load(path)


def pack(files: DataFrame, path: str, pack_bytes: int = PACK_BYTES) -> None:
    """Add documents (``source``, ``content``) to a packed folder; null content is an empty document."""
    files.sparkSession.dataSource.register(PackedFiles)
    files.select("source", "content").write.format(FORMAT).mode("append").option("pack", pack_bytes).save(path)
