"""Exact deduplication with a heavy-hitter split.

Misra-Gries style summaries (Spark's mergeable frequent-items sketch) name the digests that may be frequent. Digests are
dealt to SHARDS by their hash, with a summary each, so that no task merges the summaries of all. The exact counts and
winners of what they name come from a partially aggregated pass and are broadcast, so rows of a huge group of copies are
settled where they are read and never meet in one task. All other digests, each too rare to skew a task, take an ordinary
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WS, id_order, stored, table, text_of

#: Summaries, digests followed by each, and how many of them may be treated as heavy. They bound memory, not results.
SHARDS, TRACKED, HEAVY = 64, 1_024, 64


def normalised(column: str = "text") -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(text_of(column), WS, "")


def _rank() -> Column:
    """Smallest for the row that stays: most code points, then smallest doc_id (null last), then the text's hash, then the row's number."""
    return F.struct((-F.col("n_points")).alias("p"), id_order().alias("i"), F.col("text_key").alias("t"), F.col("row").alias("row"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest, code points, and what tells rows with one doc_id apart: a hash of the text, and a number that holds once it is written."""
    return docs.select("doc_id", F.sha2(normalised().cast("binary"), 256).alias("text_sha256"), F.length(text_of()).alias("n_points"), F.xxhash64(text_of()).alias("text_key"), F.monotonically_increasing_id().alias("row"))


def heavy_winners(rows: DataFrame, tracked: int = TRACKED, heavy: int = HEAVY) -> DataFrame:
    """At most SHARDS * heavy rows: digest, its exact number of rows, and the doc_id and number of the row that stays."""
    shard = rows.groupBy(F.pmod(F.xxhash64("text_sha256"), F.lit(SHARDS)))
    guess = shard.agg(F.expr(f"approx_top_k(text_sha256, {heavy}, {tracked})").alias("top")).select(F.explode("top").alias("t"))
    guess = guess.where("t.count > 1").select(F.col("t.item").alias("text_sha256"))
    exact = rows.join(F.broadcast(guess), "text_sha256").groupBy("text_sha256")
    exact = exact.agg(F.count("*").alias("h_size"), F.min(_rank()).alias("h_best"))
    return exact.select("text_sha256", "h_size", F.col("h_best.i.id").alias("h_keep"), F.col("h_best.row").alias("h_row"))


def exact_dedup(docs: DataFrame, tracked: int = TRACKED, heavy: int = HEAVY) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their SHA-256 without white space is equal. Null and white-space texts are equal to the empty
    text. Of equal texts the one with the most code points stays, then the smallest doc_id; a null doc_id comes last.
    Exactly one row of a group is kept: of rows with the doc_id that stays and equally long texts the one whose text hashes
    lowest, and of rows that repeat doc_id and text the first.
    An empty table gives an empty result; columns other than doc_id and text are ignored.
    """
    rows = stored(digests(docs), "digests")
    winners = stored(heavy_winners(rows, tracked, heavy), "heavy")
    split = rows.join(F.broadcast(winners), "text_sha256", "left")
    hot = split.where("h_size is not null").select("doc_id", F.col("h_keep").alias("keep_id"), F.col("h_size").alias("group_size"), (F.col("row") == F.col("h_row")).alias("kept"), "text_sha256")
    group = Window.partitionBy("text_sha256")
    rest = split.where("h_size is null").withColumn("best", F.min(_rank()).over(group))
    rest = rest.select("doc_id", F.col("best.i.id").alias("keep_id"), F.count("*").over(group).alias("group_size"), (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256")
    return hot.unionByName(rest)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS p, coalesce(text, '') AS t,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY p DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY p DESC, doc_id NULLS LAST, t) = 1 AS kept,
       text_sha256
FROM d
"""
