"""Checks that all emit one findings relation, and comparison with an earlier snapshot."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, IllegalArgumentException, NumberFormatException, PythonException, SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.text import note_references
from foliant.sources.scratch import saved

#: Faults of a check's plan or of the data it reads. Aborted jobs (lost executors, full disks, missing files) are none, and end the run.
FAULTS = (AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, IllegalArgumentException, NumberFormatException, PythonException, SparkRuntimeException, KeyError, TypeError, ValueError)
FINDING = ["checker", "page_index", "item", "severity", "reason"]


def finding(df: DataFrame, checker: str, severity, reason, page="page_index", item=None) -> DataFrame:
    col = lambda c, kind: (F.col(c) if isinstance(c, str) else F.lit(None) if c is None else c).cast(kind)
    sev = F.lit(severity) if isinstance(severity, str) else severity
    return df.select(F.lit(checker).alias("checker"), col(page, "int").alias("page_index"), col(item, "string").alias("item"), sev.alias("severity"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))


def run_checks(checks: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """The findings of all checks, numbered by their order. Each is run here and now; one with a fault of its own becomes an error finding."""
    out = []
    for i, (name, check) in enumerate(checks.items()):
        try:
            found = saved(check().select(*FINDING), "findings")
        except FAULTS as e:
            found = finding(SparkSession.active().range(1), name, "error", f"check failed: {type(e).__name__}", page=None)
        out.append(found.withColumn("checker_order", F.lit(i)))
    return reduce(DataFrame.unionByName, out)


def missing_notes(blocks: DataFrame, notes: DataFrame) -> DataFrame:
    """Notes that blocks (block_id, page_index, text) refer to and that do not exist: mentions and first block."""
    refs = blocks.select("block_id", "page_index", F.explode(note_references(F.col("text"))).alias("note"))
    lost = refs.join(notes, "note", "left_anti")
    return lost.groupBy("note").agg(F.count("*").alias("mentions"), F.min("block_id").alias("first_block"), F.min_by("page_index", "block_id").alias("page_index"))


def snapshot_diff(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Keys whose number of rows differs from an earlier snapshot."""
    a = now.groupBy(key).agg(F.count("*").alias("n_now"))
    b = before.groupBy(key).agg(F.count("*").alias("n_before"))
    x = a.join(b, key, "full").select(key, F.coalesce("n_now", F.lit(0)).alias("n_now"), F.coalesce("n_before", F.lit(0)).alias("n_before"))
    return x.where("n_now <> n_before")


def missing_sections(sections: DataFrame, group: str) -> DataFrame:
    """Required sections that a group of pages lacks: cover and toc for up to five pages, else both statements."""
    n = sections.groupBy(group).agg(F.count("*").alias("pages"), F.collect_set("section").alias("present"))
    need = F.when(F.col("pages") <= 5, F.array(F.lit("cover"), F.lit("toc"))).otherwise(F.array(F.lit("income_statement"), F.lit("balance_sheet")))
    return n.select(group, "pages", F.explode(F.array_except(need, "present")).alias("missing"))
