"""A circuit breaker for each engine, as a stream: after so many failures an engine is not called any more."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Failures after which an engine is left alone.
MOST = 3
#: What a call came to. A missing engine is left alone from then on.
FAILED, MISSING = "failed", "missing"
SCHEMA = "engine string, call_id long, called boolean, failures int"


class Breaker(StatefulProcessor):
    """Keeps an engine's failures. Rows of one batch are taken in the order of call_id; a batch holds what its trigger reads, of each engine that much at most."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._failures = handle.getValueState("failures", "n int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("call_id", kind="stable")
        n = int(self._failures.get()[0]) if self._failures.exists() else 0
        called, failures = [], []
        for outcome in batch["outcome"]:
            called.append(n < MOST)
            if n < MOST:
                n = MOST if outcome == MISSING else n + (outcome == FAILED)
            failures.append(n)
        self._failures.update((n,))
        yield pd.DataFrame({"engine": key[0], "call_id": batch["call_id"].to_numpy(), "called": called, "failures": failures})

    def close(self) -> None:
        pass


def breaker(calls: DataFrame) -> DataFrame:
    """A stream of calls (engine, call_id, outcome) with whether each is made at all, and the engine's failures after it.

    Failures add up over all batches and are not forgotten when a call succeeds; the outcome of a call that is not made does not
    count. Batches must come in the order of call_id. State lives in RocksDB and in the query's checkpoint.
    """
    calls.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return calls.select("engine", "call_id", "outcome").groupBy("engine").transformWithStateInPandas(Breaker(), outputStructType=SCHEMA, outputMode="append", timeMode="none")


def folded(calls: DataFrame) -> DataFrame:
    """The same of a table, without a stream: an engine is called until its failures so far come to MOST, or it is missing."""
    before = Window.partitionBy("engine").orderBy("call_id").rowsBetween(Window.unboundedPreceding, -1)
    weight = F.when(F.col("outcome") == MISSING, MOST).when(F.col("outcome") == FAILED, 1).otherwise(0)
    x = calls.withColumn("_b", F.coalesce(F.sum(weight).over(before), F.lit(0))).withColumn("called", F.col("_b") < MOST)
    after = F.when(F.col("called"), F.least(F.col("_b") + weight, F.lit(MOST))).otherwise(F.lit(MOST))
    return x.select("engine", F.col("call_id").cast("long").alias("call_id"), "called", after.cast("int").alias("failures"))
