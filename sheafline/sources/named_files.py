"""One text file for each document, written by Spark tasks under the documents' own names.

A task writes its documents into a folder of its own below ``_staging`` and moves them to their names when all are there, so
each file appears whole, a task that fails leaves none of its files, and an attempt that is repeated replaces what an earlier one
moved. The driver gets a count and the name of a list for each task, never the names; a job that fails removes the files its finished tasks had moved,
and tasks that are still at work then find its staging folder closed and move nothing.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from sheafline.functions.text import object_key, text

FORMAT = "named_text_files"
#: Folder for unfinished work, and the file in a job's part of it that stands there until the job is done or has failed.
STAGING, OPEN = "_staging", "open"


@dataclass
class Moved(WriterCommitMessage):
    """What a finished task moved: how many files, and the list of their names in the staging folder."""

    files: int
    listing: str


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it, of a URI or a local path."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def safe_name(name: str | None) -> str:
    """A relative path below the target folder; anything else is an error."""
    parts = (name or "").split("/")
    if not name or name.startswith("/") or ".." in parts or "" in parts or parts[0] == STAGING:
        raise ValueError(f"not a name for a document: {name!r}")
    return name


class NamedTextWriter(DataSourceArrowWriter):
    def __init__(self, root: str) -> None:
        self.root, self.job = root, uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Moved:
        store, root = opened(self.root)
        task = TaskContext.get()
        own = posixpath.join(root, STAGING, self.job, f"{task.partitionId()}-{task.taskAttemptId()}")
        store.create_dir(own, recursive=True)
        is_open = posixpath.join(root, STAGING, self.job, OPEN)
        names: list[str] = []
        try:
            for batch in batches:
                for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    with store.open_output_stream(posixpath.join(own, str(len(names)))) as out:
                        out.write((body or "").encode())
                    names.append(safe_name(name))
            if not names or store.get_file_info(is_open).type != fs.FileType.File:
                store.delete_dir(own)
                return Moved(0, "")
        except BaseException:
            store.delete_dir(own)
            raise
        listing = own + ".list"
        with store.open_output_stream(listing) as out:
            out.write("\n".join(names).encode())
        for folder in {posixpath.dirname(n) for n in names} - {""}:
            store.create_dir(posixpath.join(root, folder), recursive=True)
        for i, name in enumerate(names):
            store.move(posixpath.join(own, str(i)), posixpath.join(root, name))
        store.delete_dir(own)
        return Moved(len(names), listing)

    def commit(self, messages: list[Moved | None]) -> None:
        self._clear()

    def abort(self, messages: list[Moved | None]) -> None:
        store, root = opened(self.root)
        store.delete_file(posixpath.join(root, STAGING, self.job, OPEN))
        for done in (m for m in messages if m and m.files):
            with store.open_input_stream(done.listing) as f:
                for name in f.read().decode().splitlines():
                    if store.get_file_info(posixpath.join(root, name)).type == fs.FileType.File:
                        store.delete_file(posixpath.join(root, name))
        self._clear()

    def _clear(self) -> None:
        store, root = opened(self.root)
        for folder in (posixpath.join(root, STAGING, self.job), posixpath.join(root, STAGING)):
            found = store.get_file_info(folder).type == fs.FileType.Directory
            if found and (folder.endswith(self.job) or not store.get_file_info(fs.FileSelector(folder))):
                store.delete_dir(folder)


class NamedTextFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, document string"

    def writer(self, schema: StructType, overwrite: bool) -> NamedTextWriter:
        writer = NamedTextWriter(self.options["path"])
        store, root = opened(writer.root)
        store.create_dir(posixpath.join(root, STAGING, writer.job), recursive=True)
        with store.open_output_stream(posixpath.join(root, STAGING, writer.job, OPEN)):
            return writer


def document_name(uri: Column | str, suffix: str) -> Column:
    """The relative name of a document that comes from ``uri``: its object path without ``in/`` and extension, with a new suffix."""
    return F.concat(F.regexp_replace(F.regexp_replace(object_key(uri), r"\Ain/", ""), r"\.[^./]*\z", ""), F.lit(suffix))


def write_documents(documents: DataFrame, path: str, name: str = "name", document: str = "document") -> None:
    """A file ``path/name`` for each row, holding its text (null: empty) as UTF-8; files of that name are replaced, others stay.

    Names are relative paths; two rows of one name, or a null name, are an error before anything is written. ``path`` is a folder of any store
    that Arrow opens and all executors share. Rows are written where they are: no shuffle, one open file a task, whatever the number of documents.
    """
    rows = documents.select(F.col(name).cast("string").alias("name"), text(document).alias("document"))
    twice = rows.groupBy("name").agg(F.count("*").alias("n")).where("n > 1 or name is null").select("name").limit(3).collect()
    if twice:
        raise ValueError(f"names are not unique: {[r[0] for r in twice]}")
    documents.sparkSession.dataSource.register(NamedTextFiles)
    rows.write.format(FORMAT).mode("append").save(path)


def read_documents(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """(name, document): the files below a folder, by name. Spark's reader passes over empty files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    base = spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath().rstrip("/")
    after = F.element_at(F.split("path", F.lit(f"(?<=\\Q{base}\\E)/"), 2), 2)
    return files.select(after.alias("name"), F.col("content").cast("string").alias("document"))
