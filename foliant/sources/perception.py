"""Where image and PDF engines plug in. None is shipped: an engine is a function given by the caller.

An engine maps one file's content to rows; Spark reads the files, deals them out and gathers the rows. Decisions made
of its signals (page modes, noise gates, pass selection, staves) are DataFrame operators, not part of an engine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Engine = Callable[[str, bytes], Iterable[dict]]

#: Why a file gave no rows: null where it did. Every engine's schema ends with it.
ERROR = "error string"
MANIFEST = "path string, page_index int, width double, height double, chars int, coverage double, density double"
BLOCKS = "path string, page_index int, seq int, text string, x0 double, y0 double, x1 double, y1 double, source string, confidence double"
REGIONS = "path string, page_index int, region_idx int, type string, x0 double, y0 double, x1 double, y1 double, confidence double"
STAFF_LINES = "path string, y double, x double, width double, height double"


def read_files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (".pdf",)) -> DataFrame:
    """path and content of files below a folder; the suffix is tested on the list of files, so others are never opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    hit = F.lit(False)
    for s in suffixes:
        hit = hit | F.lower("_metadata.file_path").endswith(s)
    return files.where(hit).select("path", "content")


def run_engine(files: DataFrame, engine: Engine, schema: str) -> DataFrame:
    """The engine's rows for every file, with error; a file that it fails on gives one row with its path and what went wrong."""
    schema = f"{schema}, {ERROR}"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    rows = [{"path": path, **r} for r in engine(path, bytes(content))]
                except Exception as e:  # noqa: BLE001
                    rows = [{"path": path, "error": f"{type(e).__name__}: {e}"}]
                if rows:
                    yield pd.DataFrame(rows).reindex(columns=names).astype(object)

    return files.mapInPandas(run, schema)


def with_fallback(primary: DataFrame, files: DataFrame, engine: Engine, schema: str, pages: DataFrame | None = None) -> DataFrame:
    """primary's rows without error, and a second engine's for the pages (path, page_index) of which it has none.

    pages: all pages, where they are known; files of which every page was read are not opened again, and rows of the second engine
    for pages that were read are left out. Without them, files that have no rows are read again.
    """
    page = ["path", "page_index"]
    good = primary.where("error is null")
    read = good.select(*page).distinct()
    needed = files.join(read.select("path").distinct(), "path", "left_anti") if pages is None else files.join(pages.join(read, page, "left_anti").select("path").distinct(), "path", "left_semi")
    second = run_engine(needed, engine, schema)
    return good.unionByName(second.join(read.withColumnsRenamed({"path": "_p", "page_index": "_i"}), (F.col("path") == F.col("_p")) & F.col("page_index").eqNullSafe(F.col("_i")), "left_anti"))


def with_full_pages(regions: DataFrame, pages: DataFrame) -> DataFrame:
    """regions, and the whole page as a text region for pages (path, page_index, width, height) that have none."""
    text = regions.where("type = 'text'").select("path", "page_index").distinct()
    rest = pages.join(text, ["path", "page_index"], "left_anti")
    full = rest.select("path", "page_index", F.lit(0).alias("region_idx"), F.lit("text").alias("type"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.col("width").alias("x1"), F.col("height").alias("y1"), F.lit(1.0).alias("confidence"))
    return regions.unionByName(full)
