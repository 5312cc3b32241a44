"""The few file-system calls Spark has no DataFrame for."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def _filesystem(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def delete_path(spark: SparkSession, path: str) -> None:
    fs, where = _filesystem(spark, path)
    fs.delete(where, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none when it does not exist.  Hidden ones are left out."""
    fs, where = _filesystem(spark, path)
    if not fs.exists(where):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(where))
    return sorted(n for n in names if not n.startswith((".", "_")))


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _filesystem(spark, path)
    source = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all, and never in place of another."""
    fs, where = _filesystem(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{uuid.uuid4().hex}")
    fs.mkdirs(where.getParent())
    out = fs.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(where) or not fs.rename(hidden, where):
        fs.delete(hidden, False)
        raise FileExistsError(f"{path} was written by another run meanwhile")


def open_store(uri: str):
    """(pyarrow file system, path) of a URI, for tasks that write files of their own."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1) if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def local_path(spark: SparkSession, uri: str) -> str | None:
    """The path behind a URI of the local file system (on a cluster a mount that all machines share).

    None for other stores, and for a pattern, which only Spark's readers resolve.
    """
    fs, where = _filesystem(spark, uri)
    if fs.getUri().getScheme() != "file" or any(c in uri for c in "{}[]*?\\"):
        return None
    return where.toUri().getPath()


def exists(spark: SparkSession, uri: str) -> bool:
    fs, where = _filesystem(spark, uri)
    return fs.exists(where)


def local_files(folder: str) -> Iterator[bytes]:
    """Paths of the files at or below a local folder, without those that Spark's listing leaves out.

    One after the other, so memory does not grow with their number.
    """

    def hidden(name: bytes, is_folder: bool) -> bool:
        if is_folder and name.startswith((b"_metadata", b"_common_metadata")):
            return False
        return name.startswith(b".") or name.endswith(b"._COPYING_") or (name.startswith(b"_") and b"=" not in name)

    if os.path.isfile(folder):
        yield os.fsencode(folder)
        return
    left = [os.fsencode(folder)]
    while left:
        with os.scandir(left.pop()) as entries:
            for entry in entries:
                is_folder = entry.is_dir()
                if hidden(entry.name, is_folder):
                    continue
                if is_folder:
                    left.append(entry.path)
                else:
                    yield entry.path


class ObjectWriter:
    """Writes files of a task below a folder, each whole or not at all, and in place of one of that name.

    Object stores show a file when it is complete.  On a local file system it is written in a hidden folder of the task's own and
    linked to its name: the folder that all tasks write to is then held for one step a file, where making a file there and
    renaming it takes several.  Elsewhere it is written under a hidden name and moved.
    """

    def __init__(self, uri: str):
        self.store, self.folder = open_store(uri)
        self.local = self.store.type_name == "local"
        self.own = f"{self.folder}/.{uuid.uuid4().hex}"
        self.known: set[str] = set()

    def __enter__(self) -> ObjectWriter:
        return self

    def __exit__(self, *_) -> None:
        if os.path.isdir(self.own):
            self._drop_draft()
            os.rmdir(self.own)

    def put(self, key: str, content: bytes) -> None:
        path = f"{self.folder}/{key}"
        parent, _, name = path.rpartition("/")
        if parent not in self.known:
            self.store.create_dir(parent, recursive=True)
            self.known.add(parent)
        if self.local:
            self._link(path, content)
            return
        moved = self.store.type_name == "hdfs"
        target = f"{parent}/.{uuid.uuid4().hex}.tmp" if moved else path
        with self.store.open_output_stream(target) as out:
            out.write(content)
        if moved:
            self.store.move(target, path)

    def _link(self, path: str, content: bytes) -> None:
        draft = f"{self.own}/draft"
        os.makedirs(self.own, exist_ok=True)
        with open(draft, "xb") as out:
            out.write(content)
        try:
            os.link(draft, path)
        except OSError:  # the name is taken, or the file system has no links
            os.replace(draft, path)
        else:
            os.unlink(draft)

    def _drop_draft(self) -> None:
        try:
            os.unlink(f"{self.own}/draft")
        except FileNotFoundError:
            pass
