"""A file for each row: a data source that writes, with a commit protocol.

A task writes to a folder of its own attempt below the target's staging folder. The job's commit moves the folders of the
attempts that succeeded to part folders and drops what an earlier run left; an attempt that fails, or is run twice, leaves
nothing, and a job that fails leaves the earlier files as they were. Names are those of rows, below the part's folder.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from foliant.sources.folders import open_store

STAGING = "_staging"


@dataclass
class _Written(WriterCommitMessage):
    part: int
    folder: str
    files: int


class _Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.job = path, uuid.uuid4().hex

    def _staging(self) -> tuple[fs.FileSystem, str, str]:
        store, root = open_store(self.path)
        return store, root, f"{root}/{STAGING}/{self.job}"

    def write(self, rows: Iterator) -> _Written:
        store, _, staging = self._staging()
        part = TaskContext.get().partitionId()
        folder, names = f"{staging}/{part:05d}-{uuid.uuid4().hex}", set()
        try:
            for name, content in rows:
                if name in names or name.startswith("/") or re.search(r"(^|/)\.{0,2}(/|$)", name):
                    raise ValueError(f"no file can be named so, or two are: {name!r}")
                names.add(name)
                store.create_dir(f"{folder}/{name}".rpartition("/")[0])
                with store.open_output_stream(f"{folder}/{name}") as f:
                    f.write(bytes(content))
        except BaseException:
            if store.get_file_info(folder).type != fs.FileType.NotFound:
                store.delete_dir(folder)
            raise
        return _Written(part, folder, len(names))

    def commit(self, messages: list[_Written | None]) -> None:
        store, root, staging = self._staging()
        store.create_dir(root)
        for old in store.get_file_info(fs.FileSelector(root)):
            if re.fullmatch(r"part-\d{5,}", old.base_name):
                store.delete_dir(old.path)
        for m in messages:
            if m is not None and m.files:
                store.move(m.folder, f"{root}/part-{m.part:05d}")
        self._drop(store, root, staging)

    def abort(self, messages: list[_Written | None]) -> None:
        self._drop(*self._staging())

    def _drop(self, store: fs.FileSystem, root: str, staging: str) -> None:
        for folder in (staging, f"{root}/{STAGING}"):
            empty = folder == staging or not store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            if empty and store.get_file_info(folder).type != fs.FileType.NotFound:
                store.delete_dir(folder)


class FileSink(DataSource):
    """format("row_files"), option path; rows of name and content."""

    @classmethod
    def name(cls) -> str:
        return "row_files"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"])


def write_files(df: DataFrame, path: str, name: str = "name", content: str = "content") -> None:
    """A file below path for each row of df, with what its content column holds (text as UTF-8; null as nothing), over an earlier run's.

    Names are unique: rows that share one meet in a task, which fails. Running it again gives the same files.
    """
    df.sparkSession.dataSource.register(FileSink)
    rows = df.selectExpr(f"`{name}` AS name", f"coalesce(cast(`{content}` AS binary), X'') AS content")
    rows.repartition("name").write.format("row_files").option("path", path).mode("append").save()
