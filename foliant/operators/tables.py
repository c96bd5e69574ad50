"""Tables as cells: numbers, validity, grids, row totals and balance checks.

Cells carry table_id, row_idx, col_idx, cell_seq (their order of appearance) and text_raw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import is_blank, normalize_number, parse_number

# Labels of totals.
SUM_LABELS = ("yhteensä", "total", "sum", "kokonaismäärä")
ASSETS = ("vastaavaa yhteensä", "vastaavaa yht", "total assets", "assets total", "yhteensä vastaavaa")
LIABILITIES = ("vastattavaa yhteensä", "vastattavaa yht", "total liabilities", "liabilities total", "yhteensä vastattavaa")


def with_numbers(cells: DataFrame) -> DataFrame:
    return cells.withColumn("_n", normalize_number(F.col("text_raw"))).withColumns({"value_num": F.col("_n.value"), "unit": F.col("_n.unit")}).drop("_n")


def exactness(cells: DataFrame) -> DataFrame:
    """Counts behind the shares of blank cells, and of cells with a digit that no number came of."""
    x = with_numbers(cells)
    blank = is_blank(F.col("text_raw"))
    return x.agg(F.count("*").alias("cells"), F.count_if(blank).alias("blank"), F.count_if(~blank & F.col("text_raw").rlike(r"\d") & F.col("value_num").isNull()).alias("unparsed"))


def validity(cells: DataFrame) -> DataFrame:
    """Per table whether it is one: two different columns, and a tenth of its cells numeric."""
    numeric = F.count_if(F.trim("text_raw").rlike(r"^[\d,.\-()]+$"))
    g = cells.groupBy("table_id").agg(F.count_distinct("col_idx").alias("columns"), F.count("*").alias("cells"), numeric.alias("numeric"))
    return g.withColumn("valid", (F.col("columns") >= 2) & (F.col("numeric") * 10 >= F.col("cells")))


def looks_like_contents(cells: Column, dotted: Column, paged: Column) -> Column:
    """Of a table's counts: three cells, and a tenth dotted leaders and a tenth page numbers, or a fifth leaders."""
    dots, pages = dotted / cells, paged / cells
    return (cells >= 3) & (((dots > 0.1) & (pages > 0.1)) | (dots > 0.2))


def contents_like(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per table whether it looks like a table of contents: dotted leaders, and cells that are page numbers."""
    g = cells.groupBy(*(keys or ["table_id"])).agg(F.count("*").alias("cells"), F.count_if(F.col("text_raw").rlike(r"\.{2,}")).alias("dotted"), F.count_if(F.trim("text_raw").rlike(r"^\d{1,3}$")).alias("paged"))
    return g.withColumn("is_toc", looks_like_contents(F.col("cells"), F.col("dotted"), F.col("paged")))


def _numbered_rows(cells: DataFrame, keys: list[str], labels: tuple[str, ...]) -> DataFrame:
    """keys, row_idx, label and v (numbers after the first cell, in order) of rows whose first cell holds one of the labels."""
    parts = F.array_sort(F.collect_list(F.struct("cell_seq", "text_raw")))
    rows = cells.groupBy(*keys, "row_idx").agg(parts.alias("c"))
    rows = rows.withColumn("label", F.lower(F.col("c")[0]["text_raw"]))
    said = F.lit(False)
    for label in labels:
        said = said | F.col("label").contains(label)
    v = F.filter(F.transform(F.slice("c", 2, F.greatest(F.size("c") - 1, F.lit(0))), lambda x: parse_number(x["text_raw"])), lambda x: x.isNotNull())
    # numbers are read only in such rows: behind a generator, the filter stays before them
    return rows.where(said).select(*keys, "row_idx", "label", F.inline(F.array(F.struct(v.alias("v")))))


def row_totals(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows with a total's label whose last number differs by more than a hundredth from the sum of the ones before it."""
    keys = keys or ["table_id"]
    rows = _numbered_rows(cells, keys, SUM_LABELS).where(F.size("v") >= 2)
    expected = F.aggregate(F.slice("v", 1, F.size("v") - 1), F.lit(0.0), lambda a, x: a + x)
    rows = rows.select(*keys, "row_idx", expected.alias("expected"), F.element_at("v", -1).alias("actual"))
    return rows.where(F.abs(F.col("expected") - F.col("actual")) > 0.01)


def balance(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per table assets against liabilities, each the last number of the last row so labelled that has one: ok within half a per cent, warning within ten times that."""
    keys = keys or ["table_id"]
    rows = _numbered_rows(cells, keys, ASSETS + LIABILITIES).where(F.size("v") > 0).withColumn("last", F.element_at("v", -1))

    def side(words):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.col("label").contains(w)
        return F.max_by("last", F.when(hit, F.col("row_idx")))

    both = rows.groupBy(*keys).agg(side(ASSETS).alias("assets"), side(LIABILITIES).alias("liabilities")).where("assets is not null and liabilities is not null")
    diff, tolerance = F.abs(F.col("assets") - F.col("liabilities")), F.greatest(F.abs("assets"), F.abs("liabilities")) * 0.005
    return both.withColumn("severity", F.when(diff <= tolerance, "ok").when(diff < tolerance * 10, "warning").otherwise("error"))


def grid(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A row per table row from 0 to the last, with `cells`: its texts from column 0 to the table's last column, empty where there is none; of several writes to a cell the last counts."""
    keys = keys or ["table_id"]
    one = cells.groupBy(*keys, "row_idx", "col_idx").agg(F.max_by(F.coalesce("text_raw", F.lit("")), "cell_seq").alias("t"))
    rows = one.groupBy(*keys, "row_idx").agg(F.map_from_entries(F.collect_list(F.struct("col_idx", "t"))).alias("m"), F.max("col_idx").alias("last"))
    size = rows.groupBy(*keys).agg(F.max("row_idx").alias("rows"), F.max("last").alias("columns"))
    every = size.select(*keys, "columns", F.explode(F.sequence(F.lit(0), F.col("rows"))).alias("row_idx"))
    x = every.join(rows.drop("last"), [*keys, "row_idx"], "left")
    return x.select(*keys, "row_idx", F.transform(F.sequence(F.lit(0), F.col("columns")), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(""))).alias("cells"))


def stated(text: Column) -> Column:
    """What the words of a table's first cells, in lower case, say that it states."""
    has = lambda *words: text.rlike("|".join(words))
    return F.when(has("vastaavaa", "vastattavaa", "varat", "velat"), "balance_sheet").when(has("2023", "2024") & has("tuotot", "kulut", "tulos"), "income_statement").otherwise("unknown")


def structure_type(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """What a table states, from words in its first ten cells."""
    keys = keys or ["table_id"]
    first = F.slice(F.array_sort(F.collect_list(F.struct("cell_seq", F.lower("text_raw").alias("t")))), 1, 10)
    text = cells.groupBy(*keys).agg(F.concat_ws(" ", F.transform(first, lambda x: x["t"])).alias("t"))
    return text.select(*keys, stated(F.col("t")).alias("type"))


def header_text(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The first five cells of row 0, joined."""
    keys = keys or ["table_id"]
    first = F.slice(F.array_sort(F.collect_list(F.struct("cell_seq", "text_raw"))), 1, 5)
    return cells.where("row_idx = 0").groupBy(*keys).agg(F.concat_ws(" ", F.transform(first, lambda x: x["text_raw"])).alias("header"))


def cells_from_text(df: DataFrame) -> DataFrame:
    """Cells of plain text, by lines and white space; blank lines leave gaps in the row numbers. df: table_id, text."""
    lines = df.select("table_id", F.posexplode(F.split("text", "\n", -1)).alias("row_idx", "line")).where(F.trim("line") != "")
    return lines.select("table_id", "row_idx", F.posexplode(F.split(F.regexp_replace("line", r"^\s+|\s+$", ""), r"\s+")).alias("col_idx", "text_raw"))


def cells_from_html(df: DataFrame, tag: str = "td") -> DataFrame:
    """Cells between <tag> and </tag>, without markup, with row_idx and col_idx. df: table_id, html.

    A cell lies in the table row whose <tr> comes last before it; cells before any row are in row 0.
    """
    rows = F.split("html", r"(?i)<tr(?=[\s>])", -1)
    r = df.select("table_id", F.posexplode(rows).alias("part", "row"))
    x = r.select("table_id", "part", F.posexplode(F.regexp_extract_all("row", F.lit(rf"(?si)<{tag}(?=[\s>])[^>]*>(.*?)</{tag}>"), F.lit(1))).alias("col_idx", "raw"))
    seq = F.row_number().over(Window.partitionBy("table_id").orderBy("part", "col_idx")) - 1
    return x.select("table_id", F.greatest(F.col("part") - 1, F.lit(0)).alias("row_idx"), "col_idx", seq.alias("cell_seq"), F.trim(F.regexp_replace("raw", "<[^>]+>", "")).alias("text_raw"))
