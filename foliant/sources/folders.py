"""Files of a folder tree as rows: a data source that lists folders in tasks, prunes before it descends, and hides no name.

Spark's own file sources skip names that begin with a dot or an underscore, wherever they stand, and list folders that are
not wanted. This one takes any path or URI that Arrow's file systems know (local, HDFS, S3, GCS, ABFS).
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from foliant.sources.scratch import saved

#: Folders that the driver opens at most to find subtrees for tasks, tasks that subtrees are dealt to where no number is asked for, and files that one task's list may hold.
OPENED, DEALT, LISTED = 256, 64, 20_000
#: Bytes of files for each task that reads them, and bytes of contents in one batch.
PER_TASK, PER_BATCH = 64_000_000, 8_000_000


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    store, root = fs.FileSystem.from_uri(path if "://" in path else os.path.abspath(path.removeprefix("file:")))
    return store, root.rstrip("/") or "/"


def _children(store: fs.FileSystem, folder: str, skipped: frozenset[str]) -> tuple[list[str], list[fs.FileInfo]]:
    """Folders to descend to, links left out, and files of a folder. A folder that is gone or closed has none."""
    try:
        found = store.get_file_info(fs.FileSelector(folder))
    except (FileNotFoundError, PermissionError):
        return [], []
    local = isinstance(store, fs.LocalFileSystem)
    folders = [x.path for x in found if x.type == fs.FileType.Directory and x.base_name not in skipped and not (local and os.path.islink(x.path))]
    return folders, [x for x in found if x.type == fs.FileType.File]


class _Part(InputPartition):
    def __init__(self, folders: list[str], files: list[tuple]):
        self.folders, self.files = folders, files


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.skipped = options["path"], frozenset(json.loads(options.get("skip", "[]")))
        self.tasks = max(1, int(options.get("tasks", DEALT)))

    def _row(self, root: str, x: fs.FileInfo) -> tuple:
        return x.path[len(root) :].lstrip("/"), x.size, x.mtime

    def partitions(self) -> list[_Part]:
        store, root = open_store(self.root)
        waiting, files, opened = [root], [], 0
        while waiting and opened < OPENED:  # breadth first, so that what is left to tasks is wide
            folders, here = _children(store, waiting.pop(0), self.skipped)
            waiting += folders
            files += [self._row(root, x) for x in here]
            opened += 1
        lists = [files[i : i + LISTED] for i in range(0, len(files), LISTED)] or [[]]
        # neighbours go to different tasks; a tree of many small folders is not a task for each
        return [_Part([], f) for f in lists] + [_Part(waiting[i :: self.tasks], []) for i in range(min(self.tasks, len(waiting)))]

    def read(self, part: _Part) -> Iterator[tuple]:
        yield from part.files
        store, root = open_store(self.root)
        waiting = list(part.folders)
        while waiting:
            folders, files = _children(store, waiting.pop(), self.skipped)
            waiting += folders
            yield from (self._row(root, x) for x in files)


class FolderSource(DataSource):
    """format("folder"), options path, skip (a JSON list of folder names that are not descended to) and tasks (that subtrees are dealt to at most)."""

    @classmethod
    def name(cls) -> str:
        return "folder"

    def schema(self) -> str:
        return "path string, size long, modified timestamp"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def list_files(spark: SparkSession, root: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """path below root, size and modified of all files of a tree, but for those in folders named in skip."""
    spark.dataSource.register(FolderSource)
    return spark.read.format("folder").option("path", root).option("skip", json.dumps(list(skip))).option("tasks", str(4 * spark.sparkContext.defaultParallelism)).load()


def read_contents(files: DataFrame, root: str) -> DataFrame:
    """path and content of listed files (path, size); content is null where a file is gone or closed.

    Files are dealt out anew, as many tasks as their bytes ask for, so a folder that holds most of them is not one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_store(root)
        for b in batches:
            rows, held = [], 0
            for path in b["path"].to_pylist():
                try:
                    with store.open_input_stream(f"{top}/{path}") as f:
                        data = f.read()
                except (FileNotFoundError, PermissionError):
                    data = None
                rows.append((path, data))
                held += len(data or b"")
                if held >= PER_BATCH:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    listed = saved(files.select("path", "size"), "files")
    found = listed.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    tasks = max(1, min(found["n"], max(listed.sparkSession.sparkContext.defaultParallelism, found["bytes"] // PER_TASK + 1)))
    return listed.repartition(tasks, "path").select("path").mapInArrow(run, "path string, content binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], names=["path", "content"])
