"""Page geometry: reading order, margins, page modes, region overlap and staves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def reading_order(items: DataFrame, keys: list[str]) -> DataFrame:
    """items (keys, seq, x0, x1, y0) with `column` and `rank`: by y, then column, then arrival.

    The right edge of the first item stands for the width of the page. Centres that span less than 0.6 of it are one
    column; else items are split at half of it.
    """
    page, arrival = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("seq")
    x = items.withColumn("_c", (F.col("x0") + F.col("x1")) / 2)
    x = x.withColumns({"_w": F.first("x1").over(arrival), "_span": F.max("_c").over(page) - F.min("_c").over(page)})
    column = F.when(F.col("_span") / F.col("_w") < 0.6, 0).when(F.col("_c") < F.col("_w") / 2, 0).otherwise(1)
    x = x.withColumn("column", column)
    return x.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("y0", "column", "seq")) - 1).drop("_c", "_w", "_span")


def without_margins(items: DataFrame, toc_flag: str | None = None) -> DataFrame:
    """Items inside the middle 80 per cent of the page; contents pages keep all."""
    inside = (F.col("y0") >= F.col("height") * 0.1) & (F.col("y1") <= F.col("height") * 0.9)
    return items.where(inside | F.col(toc_flag) if toc_flag else inside)


def page_mode(pages: DataFrame) -> DataFrame:
    """How to read a page, at which resolution, and what is worth noting. pages: chars, coverage, density."""
    chars, cov, dens = F.col("chars"), F.col("coverage"), F.col("density")
    mode = F.when((chars >= 300) & (cov < 0.40), "native").when((chars < 50) & (cov >= 0.60), "scan").otherwise("mixed")
    x = pages.withColumn("mode", mode)
    dpi = F.when(F.col("mode") == "native", 0).when(dens > 0.3, 300).otherwise(250)
    notes = F.array_compact(F.array(F.when(chars >= 300, "text_ok"), F.when(cov > 0.60, "scan_like"), F.when(dens > 0.3, "table_suspicion")))
    return x.withColumns({"dpi": dpi, "device": F.when(F.col("mode") == "native", "cpu").otherwise("gpu"), "notes": F.concat_ws(",", notes)})


def for_native_text(pages: DataFrame) -> DataFrame:
    """Pages (mode) whose own text is read."""
    return pages.where(F.col("mode").isin("native", "mixed"))


def for_rendering(pages: DataFrame) -> DataFrame:
    """Pages (mode, dpi) that are drawn to be recognised."""
    return pages.where(F.col("mode").isin("scan", "mixed") & (F.col("dpi") > 0))


def for_vector_tables(pages: DataFrame) -> DataFrame:
    """Pages (mode, density) whose lines may draw tables."""
    return pages.where(F.col("mode").isin("native", "mixed") & (F.col("density") > 0.2))


def first_pages(pages: DataFrame, most: int) -> DataFrame:
    return pages.where(F.col("page_index") < most)


def crops(regions: DataFrame) -> DataFrame:
    """regions (type, x0, y0, x1, y1, width, height of the image) cut to the image, in whole pixels; those with nothing left go, and text under 10 pixels wide or high."""
    inside = lambda c, most: F.greatest(F.lit(0), F.least(F.col(c).cast("int"), F.col(most).cast("int")))
    x = regions.withColumns({"x0": inside("x0", "width"), "x1": inside("x1", "width"), "y0": inside("y0", "height"), "y1": inside("y1", "height")})
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return x.where((w > 0) & (h > 0) & ((F.col("type") != "text") | ((w >= 10) & (h >= 10))))


def region_order(regions: DataFrame, keys: list[str]) -> DataFrame:
    """regions (keys, type, region_idx, y0) with rank from 0, from top to bottom; of equals tables come first, then as they came."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("y0", F.col("type") != "table", "region_idx")) - 1
    return regions.withColumn("rank", rank)


def free_thirds(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """Thirds of pages (page_id, height) that no table region (page_id, y0, y1) touches."""
    t = pages.select("page_id", "height", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("third"))
    t = t.select("page_id", "third", (F.col("height") * F.col("third") / 3).alias("top"), (F.col("height") * (F.col("third") + 1) / 3).alias("bottom"))
    r = regions.select("page_id", "y0", "y1")
    return t.alias("t").join(r.alias("r"), (F.col("t.page_id") == F.col("r.page_id")) & ~((F.col("t.bottom") < F.col("r.y0")) | (F.col("t.top") > F.col("r.y1"))), "left_anti")


def staves(lines: DataFrame) -> DataFrame:
    """lines: img_id, ys (sorted array of line positions). Adds n_staves and their tops.

    Lines are scanned in order: five whose gaps all lie within 30 per cent of their mean are a staff, and the scan goes
    on after them; else it moves by one line. An image is a row, so the fold is over a small array.
    """
    ys = F.col("ys")
    start = F.struct(F.lit(0).alias("skip"), F.array().cast("array<double>").alias("tops"))

    def step(a, i):
        five = F.slice(ys, i + 1, 5)
        gap = lambda k: F.get(five, F.lit(k + 1)) - F.get(five, F.lit(k))
        mean = (F.get(five, F.lit(4)) - F.get(five, F.lit(0))) / 4
        fits = F.lit(True)
        for k in range(4):
            fits = fits & (F.abs(gap(k) - mean) <= 0.3 * mean)
        new = F.struct(F.lit(4).alias("skip"), F.concat(a["tops"], F.array(F.get(five, F.lit(0)))).alias("tops"))
        old = F.struct(F.greatest(a["skip"] - 1, F.lit(0)).alias("skip"), a["tops"].alias("tops"))
        return F.when((a["skip"] == 0) & F.coalesce(fits, F.lit(False)), new).otherwise(old)

    n = F.size(ys) - 5
    found = F.when(n >= 0, F.aggregate(F.sequence(F.lit(0), n), start, step)).otherwise(start)
    x = lines.withColumn("_f", found)
    return x.withColumns({"n_staves": F.size("_f.tops"), "tops": F.col("_f.tops")}).drop("_f")


def sheet_confidence(n_staves: str = "n_staves"):
    """0 under three staves, else from a half up by a twentieth for each, to 0.95."""
    return F.when(F.col(n_staves) >= 3, F.least(0.5 + F.col(n_staves) / 20, F.lit(0.95))).otherwise(0.0)


def header_lines(blocks: DataFrame, near: float = 15.0, keys: tuple[str, ...] = ("img_id",)) -> DataFrame:
    """Blocks folded into lines: a new line where y is `near` or more from the first block of the line before.

    blocks: img_id, seq, y0, text. The anchor does not move inside a line, so a lag would be wrong; the fold runs over
    the blocks of one image's header.
    """
    parts = F.array_sort(F.collect_list(F.struct("y0", "seq", "text")))
    kind = "struct<anchor:double,n:int,out:array<struct<line_no:int,seq:int,text:string>>>"
    start = F.struct(F.lit(None).cast("double").alias("anchor"), F.lit(-1).alias("n"), F.array().cast("array<struct<line_no:int,seq:int,text:string>>").alias("out")).cast(kind)

    def step(a, b):
        new = a["anchor"].isNull() | (F.abs(b["y0"] - a["anchor"]) >= near)
        n = F.when(new, a["n"] + 1).otherwise(a["n"])
        row = F.struct(n.alias("line_no"), b["seq"].cast("int").alias("seq"), b["text"].alias("text"))
        return F.struct(F.when(new, b["y0"]).otherwise(a["anchor"]).alias("anchor"), n.alias("n"), F.concat(a["out"], F.array(row)).alias("out")).cast(kind)

    x = blocks.groupBy(*keys).agg(F.aggregate(parts, start, step)["out"].alias("out")).select(*keys, F.explode("out").alias("o"))
    words = F.array_sort(F.collect_list(F.struct("o.seq", "o.text")))
    return x.groupBy(*keys, "o.line_no").agg(F.concat_ws(" ", F.transform(words, lambda w: w["text"])).alias("line"), F.count("*").alias("blocks"))
