"""Data source ``blobfiles``: writes one file per row, in parallel on the executors, and what reads the files back.

Rows need ``folder``, ``file_name`` and binary ``content``; further columns are
passed to the receipts. A file lands at ``<path>/<folder>/<file_name>``.

Each task writes a file under a staging name of its own in the target folder and then renames it,
so readers see whole files only and a retried or speculative task replaces a file by the same
bytes. The rename stays within a folder because file systems let only one rename at a time go from
folder to folder, and tasks would queue for it. Nothing about single files travels to the driver: commit messages hold
counts. With the option ``receipts`` every task also leaves a Parquet file there
with all columns but the content, plus ``n_bytes``, once its files are in place;
the receipts are the list of what is written, also after a crash. With the option ``batch``
a task leaves a receipt after every so many files: a crash then costs each task one batch at most.
Attempts of one task have receipts of their own then, so a file may be listed twice.

``path`` may be a folder on a mount shared by all executors or an object-store
URI that pyarrow can open.
"""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# Stores where an upload shows up only when complete, so no rename is needed.
ATOMIC_UPLOAD = ("s3", "gcs", "abfs")
REQUIRED = {"folder": "string", "file_name": "string", "content": "binary"}
# Files, and bytes of files, that a reading task holds at a time.
READ_FILES = 4096
READ_BYTES = 16_000_000


@dataclass
class Written(WriterCommitMessage):
    files: int
    bytes: int


class BlobFilesDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "blobfiles"

    def writer(self, schema, overwrite: bool) -> BlobFilesWriter:
        found = {field.name: field.dataType.typeName() for field in schema.fields}
        for column, kind in REQUIRED.items():
            if found.get(column) != kind:
                raise ValueError(f"blobfiles needs a {kind} column {column}, got {found}")
        if "path" not in self.options:
            raise ValueError("blobfiles needs a path: df.write.format('blobfiles').save(path)")
        batch = self.options.get("batch")
        if batch is not None and int(batch) < 1:
            raise ValueError(f"a batch holds one file or more, not {batch}")
        return BlobFilesWriter(self.options["path"], self.options.get("receipts"), int(batch) if batch else None)


class BlobFilesWriter(DataSourceArrowWriter):
    def __init__(self, root: str, receipts: str | None, batch: int | None = None) -> None:
        self.root = root
        self.receipts = receipts
        self.batch = batch
        self.token = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        partition, attempt = task.partitionId(), task.taskAttemptId()
        target = _Target(self.root, self.token, f"{partition}-{attempt}")
        receipt, number, files, total = None, 0, 0, 0
        with target:
            for batch in iterator:
                at = 0
                while at < batch.num_rows:
                    if receipt is None and self.receipts:
                        receipt = _Receipt(self.receipts, self.token, partition, attempt, number if self.batch else None)
                    room = self.batch - files % self.batch if self.batch else batch.num_rows
                    part = batch.slice(at, room)
                    folders, names, blobs = (part[c] for c in REQUIRED)
                    for i in _by_folder(folders, partition):
                        folder, name = _plain(folders[i].as_py()), _plain(names[i].as_py())
                        content = blobs[i].as_buffer()
                        if content is None:
                            raise ValueError(f"no content for {folder}/{name}")
                        target.store(folder, name, content)
                        total += content.size
                    at += part.num_rows
                    files += part.num_rows
                    if receipt:
                        receipt.add(part)
                        if self.batch and files % self.batch == 0:
                            receipt.publish()
                            receipt, number = None, number + 1
        if receipt:
            receipt.publish()
        return Written(files, total)

    def commit(self, messages: list[Written | None]) -> None:
        self._drop_staging()

    def abort(self, messages: list[Written | None]) -> None:
        # Finished files stay: their names come from their keys, so the next run
        # finds their receipts or writes them again in place.
        self._drop_staging()

    def _drop_staging(self) -> None:
        for place in filter(None, (self.root, self.receipts)):
            filesystem, base = open_filesystem(place)
            staging = staging_folder(base, self.token)
            if filesystem.get_file_info(staging).type == pafs.FileType.Directory:
                if place == self.root:
                    _drop_unfinished(filesystem, base, staging)
                filesystem.delete_dir(staging)


def _drop_unfinished(filesystem: pafs.FileSystem, base: str, staging: str) -> None:
    """Delete the files that killed tasks were writing; their marks are still in ``staging``."""
    marks = filesystem.get_file_info(pafs.FileSelector(staging))
    if not marks:
        return
    for folder in filesystem.get_file_info(pafs.FileSelector(base)):
        if folder.type == pafs.FileType.Directory and folder.path != staging:
            for mark in marks:
                _delete_if_there(filesystem, f"{staging_folder(folder.path, '')}{mark.base_name}")


def _delete_if_there(filesystem: pafs.FileSystem, path: str) -> None:
    if filesystem.get_file_info(path).type != pafs.FileType.NotFound:
        filesystem.delete_file(path)


def _by_folder(folders: pa.Array, shift: int) -> list[int]:
    """The rows folder by folder, beginning with another folder for every ``shift``.

    Tasks that change folders with every file meet at the same few folders, which take one new name at a time.
    """
    coded = folders.dictionary_encode()
    codes = coded.indices.fill_null(0).to_numpy(zero_copy_only=False)
    return np.argsort((codes + shift) % max(1, len(coded.dictionary)), kind="stable").tolist()


class _Target:
    """Stores the files of one task.

    Its unfinished file is deleted when it ends. A mark tells the driver of tasks that did not get to that.
    """

    def __init__(self, root: str, token: str, task: str) -> None:
        self.filesystem, self.base = open_filesystem(root)
        self.mark = self.name = self.unfinished = None
        if self.filesystem.type_name not in ATOMIC_UPLOAD:
            staging = staging_folder(self.base, token)
            self.filesystem.create_dir(staging, recursive=True)
            self.mark = posixpath.join(staging, f"{token}-{task}")
            self.name = staging_folder("", f"{token}-{task}")
        self.known_folders: set[str] = set()

    def __enter__(self) -> _Target:
        if self.mark:
            self.filesystem.open_output_stream(self.mark).close()
        return self

    def __exit__(self, *error: object) -> None:
        if self.unfinished:
            _delete_if_there(self.filesystem, self.unfinished)
        if self.mark:
            _delete_if_there(self.filesystem, self.mark)

    def store(self, folder: str, name: str, content: pa.Buffer) -> None:
        path = posixpath.join(self.base, folder, name)
        if self.name is None:
            with self.filesystem.open_output_stream(path) as stream:
                stream.write(content)
            return
        if folder not in self.known_folders:
            self.filesystem.create_dir(posixpath.dirname(path), recursive=True)
            self.known_folders.add(folder)
        self.unfinished = posixpath.join(self.base, folder, self.name)
        with self.filesystem.open_output_stream(self.unfinished) as stream:
            stream.write(content)
        self.filesystem.move(self.unfinished, path)
        self.unfinished = None


class _Receipt:
    """The Parquet file with the rows one task, or one batch of it, has written."""

    def __init__(self, folder: str, token: str, partition: int, attempt: int, number: int | None) -> None:
        self.filesystem, base = open_filesystem(folder)
        # The order of rows may differ between attempts, so batches of different attempts do not replace each other.
        suffix = "" if number is None else f"-{attempt}-{number:06d}"
        self.path = posixpath.join(base, f"part-{token}-{partition:06d}{suffix}.parquet")
        self.staging = None
        if self.filesystem.type_name not in ATOMIC_UPLOAD:
            staging = staging_folder(base, token)
            self.filesystem.create_dir(staging, recursive=True)
            self.staging = posixpath.join(staging, f"{partition}-{attempt}.parquet")
        self.writer: pq.ParquetWriter | None = None

    def add(self, batch: pa.RecordBatch) -> None:
        table = pa.Table.from_batches([batch])
        lengths = [value.as_buffer().size for value in batch["content"]]
        table = table.drop_columns(["content"]).append_column("n_bytes", pa.array(lengths, pa.int64()))
        if self.writer is None:
            self.writer = pq.ParquetWriter(
                self.staging or self.path, table.schema, filesystem=self.filesystem
            )
        self.writer.write_table(table)

    def publish(self) -> None:
        if self.writer is None:
            return
        self.writer.close()
        if self.staging:
            self.filesystem.move(self.staging, self.path)


def file_names(root: str):
    """For ``mapInArrow`` over folders below ``root``: rows (folder, file_name), one per file.

    Names that file readers take for hidden files are skipped, those of unfinished files among them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = open_filesystem(root)
        for batch in batches:
            for folder in batch["folder"].to_pylist():
                held: list[str] = []
                for name in _names(filesystem, posixpath.join(base, folder)):
                    held.append(name)
                    if len(held) == READ_FILES:
                        yield _named(folder, held)
                        held = []
                if held:
                    yield _named(folder, held)

    return run


def _names(filesystem: pafs.FileSystem, folder: str) -> Iterator[str]:
    if filesystem.type_name == "local":
        # One name after the other: a folder may hold millions.
        with os.scandir(folder) as found:
            yield from (e.name for e in found if not hidden(e.name) and e.is_file())
        return
    for info in filesystem.get_file_info(pafs.FileSelector(folder)):
        if info.type == pafs.FileType.File and not hidden(info.base_name):
            yield info.base_name


def _named(folder: str, names: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([folder] * len(names)), pa.array(names)], names=["folder", "file_name"])


def file_contents(root: str):
    """For ``mapInArrow`` over (folder, file_name): rows (folder, file_name, n_bytes, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = open_filesystem(root)
        for batch in batches:
            rows: list[tuple[str, str, bytes]] = []
            size = 0
            for folder, name in zip(batch["folder"].to_pylist(), batch["file_name"].to_pylist(), strict=True):
                with filesystem.open_input_file(posixpath.join(base, folder, name)) as stream:
                    rows.append((folder, name, stream.read()))
                size += len(rows[-1][2])
                if len(rows) == READ_FILES or size >= READ_BYTES:
                    yield _read(rows)
                    rows, size = [], 0
            if rows:
                yield _read(rows)

    return run


def _read(rows: list[tuple[str, str, bytes]]) -> pa.RecordBatch:
    folders, names, blobs = zip(*rows, strict=True)
    lengths = pa.array(map(len, blobs), pa.int64())
    return pa.record_batch(
        [pa.array(folders), pa.array(names), lengths, pa.array(blobs, pa.binary())],
        names=["folder", "file_name", "n_bytes", "content"],
    )


def open_filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The pyarrow file system and the path in it, for a plain path or a URI."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path.rstrip("/")
    if path.startswith("s3a://"):
        path = "s3://" + path.removeprefix("s3a://")
    filesystem, base = pafs.FileSystem.from_uri(path)
    return filesystem, base.rstrip("/")


def staging_folder(base: str, token: str) -> str:
    # Spark's readers skip names that start with an underscore.
    return posixpath.join(base, f"_staging-{token}")


def hidden(name: str) -> bool:
    """Whether Spark's readers skip files and folders of this name."""
    return name[0] in "._"


def _plain(part: str | None) -> str:
    """A single path component, so that no row can write outside the target folder.

    Names that file readers skip as hidden are refused: they would not be read back.
    """
    if not part or hidden(part) or "/" in part or "\\" in part or "\x00" in part:
        raise ValueError(f"not a usable file or folder name: {part!r}")
    return part
