"""Contents pages, targets of their entries, and the section of every page."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import FINANCIAL, strip, toc_target_page

# Words of contents pages, covers and management reports, and of contents entries by type.
TOC_WORDS = ("sisällysluettelo", "sisallysluettelo", "contents", "table of contents")
ENTRY_WORDS = {"tuloslaskelma": "income_statement", "income statement": "income_statement", "rahoituslaskelma": "cash_flow_statement", "cash flow": "cash_flow_statement", "tase": "balance_sheet", "balance sheet": "balance_sheet", "liitetiedot": "notes", "notes": "notes"}


# Words that name a section, in the order in which they are tried after contents and cover.
CONTENTS_HEADS = ("sisällysluettelo", "contents", "table of contents", "sisällys")
SECTION_WORDS = {"notes": FINANCIAL["notes"], "balance_sheet": ("tase", "balance sheet"), "income_statement": ("tuloslaskelma", "income statement"), "cash_flow_statement": FINANCIAL["cash_flow_statement"], "accounting_policies": FINANCIAL["accounting_policies"]}


def any_of(text, words):
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return hit


def contents_pages(page_text: DataFrame) -> DataFrame:
    """page_text (keys, text) with is_toc: a contents word, or three numbered items, two dotted leaders and three short numbers.

    A column toc_table, where there is one, says that a table of the page looks like one of contents: that is enough.
    """
    low = F.lower("text")
    counted = (F.regexp_count("text", F.lit(r"\d+\.\d+(\.\d+)?")) >= 3) & (F.regexp_count("text", F.lit(r"\.{3,}")) >= 2) & (F.regexp_count("text", F.lit(r"\b\d{1,3}\b")) >= 3)
    table = F.coalesce("toc_table", F.lit(False)) if "toc_table" in page_text.columns else F.lit(False)
    return page_text.withColumn("is_toc", any_of(low, TOC_WORDS) | counted | table)


def entries(lines: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Contents entries of lines (page_index, seq, text): keys, entry text, type and target page (-1 for none).

    Later entries with one text replace earlier ones, and keep their place (first).
    """
    keys = keys or ["page_index"]
    each = F.explode(F.array(*[F.struct(F.lit(w).alias("word"), F.lit(t).alias("type"), F.lit(i).alias("at")) for i, (w, t) in enumerate(ENTRY_WORDS.items())])).alias("k")
    x = lines.select(*keys, "seq", "text", each).where(F.lower("text").contains(F.col("k.word")))
    whole = F.regexp_extract_all("text", F.concat(F.lit(r"(?i)(\d+\.\d+(?:\.\d+)?\s*"), F.col("k.word"), F.lit(r"[^\n]*)")), F.lit(1))
    found = F.when(F.size(whole) > 0, whole).otherwise(F.array(F.col("k.word")))
    x = x.select(*keys, "k.type", toc_target_page(F.col("text")).alias("target"), (F.col("seq").cast("long") * 100 + F.col("k.at")).alias("n"), F.posexplode(found).alias("i", "entry"))
    write = F.struct("n", "i")
    return x.groupBy(*keys, "entry").agg(F.max_by("type", write).alias("type"), F.max_by(F.coalesce("target", F.lit(-1)), write).alias("target"), F.min("n").alias("first"))


def upper_median(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """The upper of the middle values of each group, by rank over the different values: no list is gathered."""
    keys = keys or []
    w = Window.partitionBy(*keys)
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))  # values are page offsets: few
    x = counts.select(*keys, value, F.sum("n").over(w.orderBy(value)).alias("upto"), F.sum("n").over(w).alias("all"))
    return x.where(F.col("upto") > F.expr("all div 2")).groupBy(*keys).agg(F.min(value).alias("median"))


def offset_candidates(blocks: DataFrame) -> DataFrame:
    """doc_id and offset: of blocks (doc_id, page_index, page_no, text, y0, y1, height) that show a page's number, on pages 3 to 14.

    A number alone at the foot (last 15 per cent) or head (first tenth), or "sivu" or "page" with one at the foot; from 1 to 200.
    """
    t = strip(F.col("text"))
    foot = (F.col("y0") > F.col("height") * 0.85) | (F.col("y1") > F.col("height") * 0.85)
    alone, named = F.regexp_extract(t, r"^(\d{1,3})$", 1).try_cast("int"), F.regexp_extract(F.lower(t), r"(?:sivu|page)\s*(\d{1,3})", 1).try_cast("int")
    head = F.col("y0") < F.col("height") * 0.10
    fits = lambda where, n: F.when(where & n.between(1, 200), n)
    found = F.explode(F.array_compact(F.array(fits(foot, alone), fits(foot, named), fits(head, alone))))
    x = blocks.where("page_no between 3 and 14").select("doc_id", "page_index", found.alias("n"))
    return x.select("doc_id", (F.col("page_index") - F.col("n")).alias("offset"))


def page_offsets(documents: DataFrame, blocks: DataFrame, sections: DataFrame) -> DataFrame:
    """doc_id and offset, to be added to a printed page number: the upper median of what pages show, else the first contents page less one, else 2."""
    shown = upper_median(offset_candidates(blocks), "offset", ["doc_id"])
    first = sections.where("section = 'toc'").groupBy("doc_id").agg((F.min("page_index") - 1).alias("by_toc"))
    x = documents.select("doc_id").distinct().join(shown, "doc_id", "left").join(first, "doc_id", "left")
    return x.select("doc_id", F.coalesce("median", "by_toc", F.lit(2)).cast("int").alias("offset"))


def targets(found: DataFrame, pages: DataFrame, offset: int) -> DataFrame:
    """pages (page_index) with the type that an entry points to their place, the last written entry counting."""
    t = found.where("target >= 0").withColumn("pdf_page", F.col("target") + offset).where("pdf_page >= 0")
    t = t.groupBy("pdf_page").agg(F.max_by("type", F.struct("first", "page_index", "entry")).alias("type"))
    return pages.join(t, pages.page_index == t.pdf_page, "left").select("page_index", F.coalesce("type", F.lit("none")).alias("section"))


def first_match(items: DataFrame, found: DataFrame) -> DataFrame:
    """items (page_index, seq, text) with the first entry of their page whose text they contain."""
    j = items.alias("i").join(found.alias("e"), (F.col("i.page_index") == F.col("e.page_index")) & F.lower("i.text").contains(F.lower("e.entry")))
    return j.groupBy("i.page_index", "i.seq").agg(F.min_by("e.type", "e.first").alias("type"), F.min_by("e.target", "e.first").alias("target"))


def route(pages: DataFrame) -> DataFrame:
    """What becomes of a table: list items (contents page or table), one text block (invalid), or a table."""
    return pages.withColumn("route", F.when(F.col("page_is_toc") | F.col("is_toc"), "list_items").when(~F.col("valid"), "text_block").otherwise("table"))


def section(page_text: DataFrame) -> DataFrame:
    """page_text (page_index, n_items, text, is_toc) with section and confidence: the first rule that holds.

    A column listed, where there is one, says that the page has list items or dots, which a contents head then needs. The
    last rule compares the page's number with the number of items on it.
    """
    low = F.lower("text")
    listed = F.coalesce("listed", F.lit(False)) if "listed" in page_text.columns else F.lit(False)
    rules = [
        (F.col("is_toc"), "toc", 0.9),
        ((F.col("page_index") == 0) & any_of(low, ("tilinpäätös", "financial statement", "annual report", "vuosikertomus")), "cover", 0.9),
        (any_of(low, CONTENTS_HEADS) & listed, "toc", 0.85),
        (any_of(low, ("johtajan kertomus", "management report", "hallituksen kertomus")), "management_report", 0.8),
        *[(any_of(low, words), name, 0.8 if name == "notes" else 0.7) for name, words in SECTION_WORDS.items()],
        (F.col("page_index") > F.col("n_items") * 0.8, "appendix", 0.3),
    ]
    out = F.when(F.col("page_index") == 0, F.struct(F.lit("cover").alias("s"), F.lit(0.5).alias("c"))).otherwise(F.struct(F.lit("appendix").alias("s"), F.lit(0.1).alias("c")))
    for holds, name, sure in reversed(rules):
        out = F.when(holds, F.struct(F.lit(name).alias("s"), F.lit(sure).alias("c"))).otherwise(out)
    return page_text.withColumn("_s", out).withColumns({"section": F.col("_s.s"), "confidence": F.col("_s.c")}).drop("_s")
