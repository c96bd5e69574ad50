"""Tables that are none become text blocks: rows move from one relation to the other and pages are numbered anew.

blocks: doc_id, page_index, seq, text, semantic_type. tables: doc_id, page_index, seq. cells: doc_id, page_index, seq of
their table, row_idx, col_idx, cell_seq, text_raw. seq orders the items of a page, blocks and tables alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import strip
from foliant.operators import contents, tables

PAGE, TABLE = ["doc_id", "page_index"], ["doc_id", "page_index", "seq"]


def contents_flags(blocks: DataFrame, cells: DataFrame) -> DataFrame:
    """Per page whether it is one of contents, by the words of its blocks and cells, or because one of its tables looks so."""
    parts = blocks.select(*PAGE, F.struct("seq", F.lit(-1).cast("long").alias("cell"), "text").alias("p"))
    parts = parts.unionByName(cells.select(*PAGE, F.struct("seq", F.col("cell_seq").cast("long").alias("cell"), F.col("text_raw").alias("text")).alias("p")))
    text = F.concat(F.lit(" "), F.concat_ws(" ", F.transform(F.array_sort(F.collect_list("p")), lambda p: p["text"])))
    like = tables.contents_like(cells, TABLE).groupBy(*PAGE).agg(F.bool_or("is_toc").alias("toc_table"))
    pages = parts.groupBy(*PAGE).agg(text.alias("text")).join(like, PAGE, "left")
    return contents.contents_pages(pages).select(*PAGE, F.col("is_toc").alias("page_is_toc"))


def routed(tables_: DataFrame, blocks: DataFrame, cells: DataFrame) -> DataFrame:
    """tables with route: list_items on contents pages and for tables that look like contents, text_block for those that are no tables, else table."""
    like = tables.contents_like(cells, TABLE).select(*TABLE, "is_toc")
    valid = cells.groupBy(*TABLE).agg(F.count_distinct("col_idx").alias("columns"), F.count("*").alias("cells"), F.count_if(F.trim("text_raw").rlike(r"^[\d,.\-()]+$")).alias("numeric"))
    valid = valid.select(*TABLE, ((F.col("columns") >= 2) & (F.col("numeric") * 10 >= F.col("cells"))).alias("valid"))
    x = tables_.join(contents_flags(blocks, cells), PAGE, "left").join(like, TABLE, "left").join(valid, TABLE, "left")
    x = x.fillna(False, ["page_is_toc", "is_toc", "valid"])
    return contents.route(x).select(*tables_.columns, "route")


def list_items(cells: DataFrame) -> DataFrame:
    """TABLE, row_idx and text of table rows: their cells in the order of columns, stripped and joined; blank rows go."""
    parts = F.array_sort(F.collect_list(F.struct("col_idx", "cell_seq", strip(F.coalesce("text_raw", F.lit(""))).alias("t"))))
    rows = cells.groupBy(*TABLE, "row_idx").agg(strip(F.concat_ws(" ", F.transform(parts, lambda p: p["t"]))).alias("text"))
    return rows.where("text <> ''")


def text_blocks(cells: DataFrame) -> DataFrame:
    """TABLE and text of whole tables: their cells in order, stripped, blank ones left out, joined; tables without text go."""
    parts = F.array_sort(F.collect_list(F.struct("cell_seq", strip(F.coalesce("text_raw", F.lit(""))).alias("t"))))
    texts = F.filter(F.transform(parts, lambda p: p["t"]), lambda t: t != "")
    return cells.groupBy(*TABLE).agg(F.concat_ws(" ", texts).alias("text")).where("text <> ''")


def refined(blocks: DataFrame, tables_: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """blocks, tables and cells after tables that are none have become blocks, all with a new `seq` and blocks with an id.

    The rows of a table of contents become list items, one block each; a table that is none becomes one text block. What
    moved stands where its table stood: its place is the table's with the row behind it, and the page's items are then numbered
    from 0. Ids are p<page>_b<seq>, p<page>_b_toc_<row> and p<page>_b_from_table_<seq>, with the old seq of what they came from.
    """
    route = routed(tables_, blocks, cells)
    of = lambda r: cells.join(route.where(F.col("route") == r).select(*TABLE), TABLE, "left_semi")
    page = F.col("page_index").cast("string")
    block_id = lambda what, n: F.concat(F.lit("p"), page, F.lit(what), F.col(n).cast("string"))
    at = lambda row: F.struct(F.col("seq").cast("long").alias("seq"), row.cast("long").alias("row"))
    zero, kept = F.lit(0), route.where("route = 'table'")
    old = blocks.select(*PAGE, at(zero).alias("at"), block_id("_b", "seq").alias("block_id"), "text", "semantic_type")
    items = list_items(of("list_items")).select(*PAGE, at(F.col("row_idx")).alias("at"), block_id("_b_toc_", "row_idx").alias("block_id"), "text", F.lit("list_item").alias("semantic_type"))
    whole = text_blocks(of("text_block")).select(*PAGE, at(zero).alias("at"), block_id("_b_from_table_", "seq").alias("block_id"), "text", F.lit("text").alias("semantic_type"))
    every = old.unionByName(items).unionByName(whole)
    place = kept.select(*PAGE, at(zero).alias("at"), F.lit(None).cast("string").alias("block_id"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("semantic_type"))
    n = F.row_number().over(Window.partitionBy(*PAGE).orderBy("at", F.col("block_id").isNull(), "block_id")) - 1
    numbered = every.unionByName(place).withColumn("new_seq", n)
    new_blocks = numbered.where("block_id is not null").select(*PAGE, F.col("new_seq").alias("seq"), "block_id", "text", "semantic_type")
    moved = numbered.where("block_id is null").select(*PAGE, F.col("at.seq").alias("seq"), "new_seq")
    renumber = lambda df: df.join(moved, TABLE).drop("seq").withColumnRenamed("new_seq", "seq").select(*df.columns)
    return new_blocks, renumber(tables_), renumber(cells)
