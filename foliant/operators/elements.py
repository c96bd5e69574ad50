"""What a block is: by its font, its place and its words; and pages by strong indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import is_blank

# Phrases of which two on a page settle its section. They are compared in lower case.
INDICATORS = {
    "balance_sheet": ("vastaavaa", "vastattavaa", "pysyvät vastaavat", "vaihtuvat vastaavat", "oma pääoma", "vieras pääoma"),
    "income_statement": ("toimintatuotot", "toimintakulut", "vuosikate", "tilikauden tulos", "satunnaiset tuotot", "satunnaiset kulut"),
    "cash_flow_statement": ("toiminnan rahavirta", "investointien rahavirta", "rahoituksen rahavirta", "rahavarojen muutos"),
}
HEADER_WORDS = ("tase", "tuloslaskelma", "liite", "notes")
BULLETS = ("•", "-", "1.", "2.", "3.")


def block_kinds(blocks: DataFrame) -> DataFrame:
    """blocks (font, size, text) with bold, italic and kind: title (a font over 12 and under 100 characters), list_item or text."""
    font = F.lower("font")
    bullet = F.lit(False)
    for b in BULLETS:
        bullet = bullet | F.trim("text").startswith(b)
    kind = F.when((F.col("size") > 12) & (F.length("text") < 100), "title").when(bullet, "list_item").otherwise("text")
    return blocks.withColumns({"bold": font.contains("bold") | font.contains("black"), "italic": font.contains("italic") | font.contains("oblique"), "kind": kind})


def numbered(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """blocks (keys, seq, text) without blank ones, with block_no from 0 within their page."""
    full = blocks.where(~is_blank(F.col("text")))
    return full.withColumn("block_no", F.row_number().over(Window.partitionBy(*keys).orderBy("seq")) - 1)


def semantic_types(items: DataFrame) -> DataFrame:
    """items (kind table or block, semantic_type, is_first, bold, text) with semantic_type filled in; one that is there stays."""
    low = F.trim(F.lower("text"))
    named = F.lit(False)
    for w in HEADER_WORDS:
        named = named | low.contains(w)
    words = F.size(F.filter(F.split(low, r"\s+"), lambda w: w != ""))
    t = (
        F.when(F.col("kind") == "table", "table")
        .when(F.col("semantic_type").isNotNull(), F.col("semantic_type"))
        .when(F.col("is_first") & (F.length(low) < 100) & (words <= 5), "title")
        .when((F.length(low) < 50) & F.col("bold") & named, "section_header")
        .when(low.rlike(r"^[\d•\-*]\s+"), "list_item")
        .otherwise("text")
    )
    return items.withColumn("semantic_type", t)


def indicated(pages: DataFrame) -> DataFrame:
    """pages (text) with section and confidence where two indicators of one kind occur, or long text speaks of notes; else null and 0."""
    low = F.lower("text")
    out = F.when((low.contains("liitetiedot") | low.contains("liite ")) & (F.length("text") > 500), F.struct(F.lit("notes").alias("s"), F.lit(0.7).alias("c"))).otherwise(F.struct(F.lit(None).cast("string").alias("s"), F.lit(0.0).alias("c")))
    for section, phrases in reversed(INDICATORS.items()):
        hits = sum((low.contains(p).cast("int") for p in phrases), F.lit(0))
        out = F.when(hits >= 2, F.struct(F.lit(section).alias("s"), F.lit(0.9).alias("c"))).otherwise(out)
    return pages.withColumn("_s", out).withColumns({"section": F.col("_s.s"), "confidence": F.col("_s.c")}).drop("_s")


def settled_sections(pages: DataFrame) -> DataFrame:
    """pages (section, confidence, target, hard, hard_confidence): contents and cover pages stay; else a contents target (0.85), an indicated section, or what there is."""
    fixed = F.col("section").isin("toc", "cover")
    s = F.when(fixed, F.struct("section", "confidence")).when(F.col("target").isNotNull(), F.struct(F.col("target").alias("section"), F.lit(0.85).alias("confidence"))).when(F.col("hard").isNotNull(), F.struct(F.col("hard").alias("section"), F.col("hard_confidence").alias("confidence"))).otherwise(F.struct("section", "confidence"))
    return pages.withColumn("_s", s).withColumns({"section": F.col("_s.section"), "confidence": F.col("_s.confidence")}).drop("_s", "target", "hard", "hard_confidence")
