"""What the training-data operators share: table access, durable intermediate tables, and size-checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.sources.scratch import run_dir

#: The white space of every operator here: space and U+0009 to U+000D.
WS = " \t\n\x0b\x0c\r"
#: The same as a regular expression class body, for Spark and DuckDB alike.
WS_CLASS = "\\x20\\x09-\\x0D"


#: Bytes of rows that Spark hands to a Python worker at once, and of texts that a task works on at a time.
BATCH_BYTES, HELD_BYTES = 32_000_000, 8_000_000


def bound_batches(spark: SparkSession) -> None:
    """Batches that go to Python workers hold so many bytes at most, or one row. The setting stays in the session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_slices(texts: pa.Array, rows: int) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of texts: at most so many rows and HELD_BYTES, one text at least."""
    first, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > first and (held + n > HELD_BYTES or i - first == rows):
            yield first, i - first
            first, held = i, 0
        held += n
    if len(texts) > first:
        yield first, len(texts) - first


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCRATCH: ContextVar[str] = ContextVar("scratch", default="")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at the end, but for those stored to stay: results must be written by then."""
    name = f"/scratch-{uuid.uuid4().hex}"
    token = _SCRATCH.set(name)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        _delete(spark, run_dir(spark) + name)


def stored(df: DataFrame, name: str, stays: bool = False) -> DataFrame:
    """df written as Parquet under the shared folder and read again.

    Lineage ends here: a lost executor costs a re-read of the table and never a re-run of the stages before it.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{run_dir(spark)}{'' if stays else _SCRATCH.get()}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for t in tables:
        if path := getattr(t, "_stored_at", None):
            _delete(t.sparkSession, path)


def within(df: DataFrame, rows: int, megabytes: int = 64) -> bool:
    """Whether df has at most so many rows and, written out as JSON, so many megabytes; reads no more rows than it must."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    found = df.limit(rows + 1).agg(F.count("*").alias("n"), size.alias("b")).first()
    return found["n"] <= rows and (found["b"] or 0) <= megabytes * 1_000_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """df marked for broadcast when it is `within` so many rows; else as it is, for a shuffled join that AQE may split."""
    return F.broadcast(df) if within(df, rows) else df


def text_of(column: str = "text") -> Column:
    """The text, a null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def id_order(column: str = "doc_id") -> Column:
    """A sort key for ids in which nulls come last, for use inside structs."""
    return F.struct(F.col(column).isNull().alias("missing"), F.col(column).alias("id"))
