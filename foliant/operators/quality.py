"""Text quality of blocks, pages and passes, and the verdicts made of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import bare, is_bad, is_blank, quality, quality_counts, ratio, status_counts, tokens
from foliant.operators.trigrams import with_top

STRICT, LENIENT = 0.10, 0.20


def _once(df: DataFrame, **columns) -> DataFrame:
    """df with columns out of a generator: as plain columns they would be inlined, and computed, at every use."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def with_quality(df: DataFrame, text: str = "text") -> DataFrame:
    """df with its measures, status, score and `noisy` (the noise gate)."""
    q = _once(df, _c=bare(F.col(text)), _t=tokens(F.col(text)))
    q = _once(q, _q=quality_counts("_c", "_t", F.col(text)))
    return q.withColumns(quality("_q")).drop("_q", "_c", "_t")


def with_bad(df: DataFrame, text: str = "text") -> DataFrame:
    """df with `status` "bad" or null: what verdicts need, without looking at tokens."""
    q = _once(_once(df, _c=bare(F.col(text))), _q=status_counts("_c", F.col(text)))
    return q.withColumn("status", F.when(~F.col("_q.blank") & is_bad("_q"), "bad")).drop("_q", "_c")


def smoke(df: DataFrame, key: str, text: str = "text", k: int = 10) -> DataFrame:
    """Per text (key) the characters of an average word, the share of other characters than letters, and its k most frequent trigrams as "abc:3", joined by commas.

    Trigrams are of letters and digits, lower-cased, of the text without spaces and line feeds; of equals the first seen
    comes first. A blank text has 0, 0 and none.
    """
    x = _once(df.select(key, F.col(text).alias("_text")), blank=is_blank(F.col("_text")), bare=bare(F.col("_text")), word=F.regexp_extract_all(F.coalesce(F.col("_text"), F.lit("")), F.lit(r"(?U)\w+"), F.lit(0)))
    x = x.select(key, "blank", "bare", F.length(F.regexp_replace("bare", r"\P{L}+", "")).alias("letters"), F.length("bare").alias("chars"), F.size("word").alias("words"), F.length(F.array_join("word", "")).alias("word_chars"))
    unless = lambda c: F.when(F.col("blank"), F.lit(0.0)).otherwise(c)
    base = x.select(key, unless(ratio(F.col("word_chars"), F.col("words"))).alias("chars_per_word"), unless(ratio(F.col("chars") - F.col("letters"), F.col("chars"))).alias("non_alpha_ratio"), F.when(~F.col("blank"), F.col("bare")).alias("bare"))
    top = F.array_join(F.transform("top", lambda v: F.concat(v["t"], F.lit(":"), v["n"].cast("string"))), ",")
    # rows without a key have none, as a join by key gives them none
    return with_top(base, key, "bare", k, folded=True, keys=df.select(key)).select(key, "chars_per_word", "non_alpha_ratio", F.when(F.col(key).isNotNull(), top).otherwise("").alias("top"))


def page_text(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """The texts of a page's blocks in order, joined by spaces. A page is small: its blocks meet in one row."""
    parts = F.array_sort(F.collect_list(F.struct("seq", "text")))
    return blocks.groupBy(*keys).agg(F.concat_ws(" ", F.transform(parts, lambda x: x["text"])).alias("text"))


def verdict(df: DataFrame, by: list[str]) -> DataFrame:
    """Share of bad rows per group and what the gate says: PASSED, WARNING (over a tenth), FAILED (over a fifth)."""
    g = df.groupBy(*by).agg(F.count("*").alias("pages"), F.count_if(F.col("status") == "bad").alias("bad"))
    share = F.col("bad") / F.col("pages")
    return g.select(*by, "pages", "bad", F.when(share > LENIENT, "FAILED").when(share > STRICT, "WARNING").otherwise("PASSED").alias("verdict"))


def best_pass(passes: DataFrame) -> DataFrame:
    """Of each region the pass that reads best: first by its longest run, then by a mix of measures, then the earliest."""
    q = with_quality(passes)
    run = F.col("repeat_run_max")
    primary = F.when(run >= 10, -run).when(run >= 8, 10 - run).otherwise(20 - run)
    secondary = 0.4 * F.col("alpha_ratio") + 0.3 * (1 - F.col("junk_token_ratio")) + 0.2 * F.least(F.col("avg_word_len") / 8, F.lit(1.0)) + 0.1 * F.col("score")
    q = q.withColumns({"primary": primary.cast("int"), "secondary": secondary})
    order = Window.partitionBy("region_id").orderBy(F.desc("primary"), F.desc("secondary"), "pass", "text")
    return q.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def needs_retry(df: DataFrame) -> DataFrame:
    """Rows of which another recognition pass is worth while."""
    return df.where((F.col("status") == "bad") | F.col("noisy"))


def worst(df: DataFrame, k: int = 5) -> DataFrame:
    """The k bad rows with the lowest score."""
    return df.where(F.col("status") == "bad").orderBy("score", "doc_id").limit(k)
