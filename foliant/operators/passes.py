"""Recognition in passes: the next engine sees only what the earlier ones read badly, and a second engine what the first did not read."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.operators.quality import best_pass, with_quality
from foliant.sources.scratch import saved

#: Regions with their text as an engine reads it: the regions' columns and `text`, null where it fails. Regions that it leaves out count as failed.
Engine = Callable[[DataFrame], DataFrame]
#: The longest run of a failed pass: it counts as noise, so the pass after it is run.
FAILED = 999


def _run(engine: Engine, regions: DataFrame, number: int) -> DataFrame:
    """region_id, pass, text, its measures and `run`, a row for each region."""
    read = engine(regions).select("region_id", "text")
    x = with_quality(regions.select("region_id").join(read, "region_id", "left"))
    x = x.withColumn("run", F.when(F.col("text").isNull(), FAILED).otherwise(F.col("repeat_run_max")))
    return saved(x.withColumn("pass", F.lit(number)), f"pass-{number}")


def _asks_for_second() -> Column:
    few = (F.col("alpha_ratio") < 0.3) & (F.col("digit_ratio") < 0.05)
    return (F.col("text") != "") & ((F.col("status") == "bad") | (F.col("run") >= 10) | few)


def adaptive_passes(regions: DataFrame, engines: list[Engine]) -> DataFrame:
    """All passes that were run: region_id, pass, text, status, score, repeat_run_max and the other measures.

    Every region has a first pass. One that reads badly (noise, or few letters and digits) and not nothing has a second; from
    there on a region goes on while its last pass has a run of eight or more, or failed. Each pass is written before the next
    is planned, and its engine gets the regions that are left, all their columns included, and no others. regions: region_id, unique.
    """
    done, left = [], regions
    for number, engine in enumerate(engines, 1):
        done.append(_run(engine, left, number))
        again = done[-1].where(_asks_for_second() if number == 1 else F.col("run") >= 8).select("region_id")
        if number == len(engines) or again.isEmpty():
            break
        left = regions.join(again, "region_id", "left_semi")
    return reduce(DataFrame.unionByName, done)


def chosen_passes(passes: DataFrame) -> DataFrame:
    """Per region the pass that reads best, and `passes`, how many were run. Passes without text are chosen only where all are."""
    n = passes.groupBy("region_id").agg(F.count("*").alias("passes"), F.bool_or(F.coalesce(F.col("text") != "", F.lit(False))).alias("read"))
    x = passes.select("region_id", "pass", "text").join(n, "region_id")
    x = x.where((F.coalesce("text", F.lit("")) != "") | (~F.col("read") & (F.col("pass") == 1)))
    return best_pass(x).drop("primary", "secondary", "read")


def by_region(regions: DataFrame, first: Engine, second: Engine, page: list[str]) -> DataFrame:
    """Regions with text and engine (1 or 2): the first engine's, and the second's for pages of which the first read nothing at all.

    A region is known by its page's keys and region_id, so one page of a file that was read does not stand for the others. Blank
    texts count as nothing read. What neither reads is left out.
    """
    keys = [*page, "region_id"]
    read = lambda engine, x, n: engine(x).select(*keys, "text").where(F.trim("text") != "").withColumn("engine", F.lit(n))
    one = saved(read(first, regions, 1), "first-engine")
    rest = regions.join(one.select(*page).distinct(), page, "left_anti")
    return one.unionByName(read(second, rest, 2))
