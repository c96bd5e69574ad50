"""Results that are kept between runs: only rows whose content changed are computed again.

A run writes the results of what is new or changed, then a manifest: every key with its digest and the run in which its result
lies. The manifest is the commit: a run that ends before it is as if it had not been, and may be repeated under its number. No
result is ever trusted because a file of its name exists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _runs(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the runs that were committed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, "manifest")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    found = [s.getPath() for s in store.listStatus(path)]
    return sorted(int(p.getName().removeprefix("run=")) for p in found if p.getName().startswith("run=") and store.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def digest(columns: list[str]):
    """SHA-256 of some columns; nulls differ from empty texts."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def refresh(rows: DataFrame, key: str, content: list[str], compute: Callable[[DataFrame], DataFrame], folder: str, run: int | None = None, partial: bool = False) -> DataFrame:
    """All results as of `rows`, computing only those of rows that are new or have other content than at the last run.

    compute maps rows to results with the key in them, one or many for each; key is unique and not null. Keys that are gone lose their
    results, unless rows are `partial`: then they keep them. run: the number under which this run is written, the next one by
    default; a number that is committed is not run again. The result has the column run, the run that computed it.
    """
    spark = rows.sparkSession
    done = _runs(spark, folder)
    run = (done[-1] + 1 if done else 0) if run is None else run
    if run not in done:
        now = rows.select(key, digest(content).alias("now"))
        last = [r for r in done if r < run]
        none = now.select(key, F.lit("").alias("digest"), F.lit(0).cast("long").alias("result_run")).where("false")
        was = spark.read.parquet(f"{folder}/manifest/run={last[-1]}") if last else none
        x = was.join(now, key, "full" if partial else "right")
        same = F.col("now").isNull() | F.coalesce(F.col("now") == F.col("digest"), F.lit(False))
        x = x.select(key, F.coalesce("now", "digest").alias("digest"), F.when(same, F.col("result_run")).otherwise(F.lit(run).cast("long")).alias("result_run"))
        x.write.mode("overwrite").parquet(f"{folder}/plan/run={run}")
        plan = spark.read.parquet(f"{folder}/plan/run={run}")
        changed = rows.join(plan.where(F.col("result_run") == run).select(key), key, "left_semi")
        compute(changed).write.mode("overwrite").parquet(f"{folder}/result/run={run}")
        plan.write.mode("overwrite").parquet(f"{folder}/manifest/run={run}")
    return results(spark, key, folder, run)


def results(spark: SparkSession, key: str, folder: str, run: int | None = None) -> DataFrame:
    """The results of a committed run, by default the last; partitions of runs that none of its keys needs are not read."""
    run = _runs(spark, folder)[-1] if run is None else run
    manifest = spark.read.parquet(f"{folder}/manifest/run={run}").select(key, F.col("result_run").alias("run"))
    needed = [r["run"] for r in manifest.select("run").distinct().collect()] or [run]  # one for each run at most
    found = spark.read.option("basePath", f"{folder}/result").parquet(*[f"{folder}/result/run={r}" for r in needed])
    found = found.withColumn("run", F.col("run").cast("long"))
    return found.join(manifest, [key, "run"])


def refresh_stream(stream: DataFrame, key: str, content: list[str], compute: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str):
    """A stream of changed rows: each batch is a run under its own number, so a batch that is repeated after a failure writes the same.

    Rows of a batch replace those with their key; keys that a batch lacks keep what they have. Of several rows with a
    key in one batch the one with the greatest content counts.
    """

    def batch(df: DataFrame, number: int) -> None:
        one = df.groupBy(key).agg(F.max(F.struct(*content)).alias("c")).select(key, "c.*")
        refresh(one, key, content, compute, folder, number, partial=True)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
