"""Where to look on a page: text between staves, and tables drawn by lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from foliant.operators.graph import components
from foliant.sources.scratch import saved

#: Width and height that a table has at least, and how sure lines both ways make.
LEAST_SIDE, DRAWN = 100, 0.7
#: How far apart lines may end that count as touching, and the side of a cell of the grid by which they are joined.
NEAR, CELL = 5.0, 128.0
#: Lines of a page whose groups one task finds at once, pair by pair; larger pages are joined and grouped across tasks.
AT_ONCE = 128
SEGMENT, BOX = ["page_id", "segment_id", "kind", "x0", "y0", "x1", "y1"], ["x0", "y0", "x1", "y1"]


def sheet_regions(images: DataFrame) -> DataFrame:
    """img_id, name, x0, y0, x1, y1 of the parts of a music sheet that lie outside its staves.

    images: img_id, width, height, staves (array of top_y and bottom_y, from top to bottom). The header ends 20 above the first
    staff (15 per cent of the height without one) and is 10 high at least; the footer begins 40 below the last (92 per cent) where
    more than 10 are left; between two staves lies a band 15 off both, 5 per cent in from the sides, where more than 10 are left.
    Parts are cut to the image; those without area go.
    """
    w, h = F.col("width"), F.col("height")
    share = lambda c, part: (c * F.lit(part)).cast("int")
    first, last = F.get("staves", F.lit(0)), F.get("staves", F.size("staves") - 1)
    foot = F.coalesce(last["bottom_y"] + 40, share(h, 0.92))
    part = lambda name, x0, y0, x1, y1: F.struct(name.alias("name"), x0.cast("int").alias("x0"), y0.cast("int").alias("y0"), x1.cast("int").alias("x1"), F.least(y1, h).cast("int").alias("y1"))
    header = part(F.lit("header"), F.lit(0), F.lit(0), w, F.greatest(F.lit(10), F.coalesce(first["top_y"] - 20, share(h, 0.15))))
    footer = F.when(foot < h - 10, part(F.lit("footer"), F.lit(0), foot, w, h))
    pairs = F.transform(F.slice("staves", 2, F.greatest(F.size("staves") - 1, F.lit(0))), lambda s, i: F.struct(i.alias("i"), (F.get("staves", i)["bottom_y"] + 15).alias("top"), (s["top_y"] - 15).alias("bottom")))
    gaps = F.transform(F.filter(pairs, lambda p: p["bottom"] > p["top"] + 10), lambda p: part(F.concat(F.lit("between_staff_"), p["i"].cast("string"), F.lit("_"), (p["i"] + 1).cast("string")), share(w, 0.05), p["top"], share(w, 0.95), p["bottom"]))
    found = images.select("img_id", F.explode(F.concat(F.array_compact(F.array(header, footer)), gaps)).alias("r")).select("img_id", "r.*")
    return found.where("x1 > x0 and y1 > y0")


def touching(segments: DataFrame, near: float = NEAR, cell: float = CELL) -> DataFrame:
    """a, b (a < b): segments of one page whose boxes, grown by near on all sides, meet. segments: page_id, segment_id, x0, y0, x1, y1.

    They are joined by the cells of a grid that their grown boxes lie on; a pair that shares several cells is found in the
    first of them only, which the larger of the two left, and the larger of the two upper, cells are.
    """
    half = near / 2
    at = lambda c, off: F.floor((F.col(c) + off) / cell)
    s = segments.select("page_id", F.struct("page_id", "segment_id").alias("node"), "x0", "y0", "x1", "y1", at("x0", -half).alias("cx0"), at("y0", -half).alias("cy0"), at("x1", half).alias("cx1"), at("y1", half).alias("cy1"))
    g = s.withColumn("cx", F.explode(F.sequence("cx0", "cx1"))).withColumn("cy", F.explode(F.sequence("cy0", "cy1")))
    a, b = g.alias("a"), g.alias("b")
    c = lambda x: F.col(x)
    same = (c("a.page_id") == c("b.page_id")) & (c("a.cx") == c("b.cx")) & (c("a.cy") == c("b.cy")) & (c("a.node") < c("b.node"))
    meet = (c("a.x0") <= c("b.x1") + near) & (c("b.x0") <= c("a.x1") + near) & (c("a.y0") <= c("b.y1") + near) & (c("b.y0") <= c("a.y1") + near)
    first = (c("a.cx") == F.greatest("a.cx0", "b.cx0")) & (c("a.cy") == F.greatest("a.cy0", "b.cy0"))
    return a.join(b, same & meet & first).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def _groups(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray, a: np.ndarray, b: np.ndarray, near: float) -> np.ndarray:
    """The first row of each row's group, of rows of which the pairs (a, b) are tried."""
    meet = (x0[a] <= x1[b] + near) & (x0[b] <= x1[a] + near) & (y0[a] <= y1[b] + near) & (y0[b] <= y1[a] + near)
    a, b = a[meet], b[meet]
    at = np.arange(len(x0))
    while True:
        low = at.copy()
        np.minimum.at(low, a, at[b])
        np.minimum.at(low, b, at[a])
        low = low[low]
        if (low == at).all():
            return at
        at = low


def _page_boxes(t: pa.Table, near: float) -> tuple[pa.Table, pa.Table]:
    """The boxes of groups on whole pages, one after another in t, and the rows of pages that must go the general way.

    Those are pages of more lines than AT_ONCE, and what pairs of boxes do not cover: nulls, no numbers, sides turned round, ids that repeat.
    """
    page, n = t["page_id"].combine_chunks(), t["_n"].to_numpy()
    new = np.concatenate(([True], pc.fill_null(pc.not_equal(page[1:], page[:-1]), True).to_numpy(zero_copy_only=False)))
    odd = (n > AT_ONCE) | np.logical_or.reduce([pc.is_null(t[c]).to_numpy() for c in SEGMENT])
    x0, y0, x1, y1 = (pc.fill_null(t[c].cast(pa.float64()), 0.0).to_numpy() for c in BOX)
    odd |= ~np.isfinite(x0 + y0 + x1 + y1) | (x0 > x1) | (y0 > y1)
    ids, kind = (pc.fill_null(pc.dictionary_encode(t[c].combine_chunks()).indices, 0).to_numpy() for c in ("segment_id", "kind"))
    starts, of = np.flatnonzero(new), np.cumsum(new) - 1
    order = np.lexsort((ids, of))
    twice = (of[order][1:] == of[order][:-1]) & (ids[order][1:] == ids[order][:-1])
    odd[order[1:][twice]] = True
    odd = np.logical_or.reduceat(odd, starts)[of]
    size, good = np.bincount(of)[of], np.flatnonzero(~odd)
    left = np.repeat(good, size[good])
    right = starts[of[left]] + np.arange(len(left)) - np.repeat(np.cumsum(size[good]) - size[good], size[good])
    at = _groups(x0, y0, x1, y1, left[left < right], right[left < right], near)
    good = good[np.lexsort((kind[good], at[good]))]
    if not len(good):
        return t.slice(0, 0), t.filter(pa.array(odd))
    first = np.concatenate(([True], at[good][1:] != at[good][:-1]))
    kinds = np.add.reduceat((first | np.concatenate(([True], kind[good][1:] != kind[good][:-1]))).astype(np.int64), np.flatnonzero(first))
    edge = np.flatnonzero(first)
    box = {c: pa.array(f.reduceat(v[good], edge)).cast(t.schema.field(c).type) for c, v, f in (("x0", x0, np.minimum), ("y0", y0, np.minimum), ("x1", x1, np.maximum), ("y1", y1, np.maximum))}
    boxes = pa.table({"page_id": page.take(pa.array(good[edge])), **box, "lines": pa.array(np.diff(np.append(edge, len(good)))), "kinds": pa.array(kinds)})
    return boxes.filter(pa.array(kinds == 2)), t.filter(pa.array(odd))


def _by_page(near: float, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for b in batches:
            t = pa.Table.from_batches([b]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([b])])
            kept = None
            if len(t):
                last = t["page_id"][-1]
                whole = t["_n"][-1].as_py()
                if last.is_valid and whole <= AT_ONCE:  # a page that may go on in the next batch waits for it
                    held = min(whole, len(t))
                    tail = pc.equal(t["page_id"].slice(len(t) - held), last).to_numpy().sum()
                    if tail < whole:
                        t, kept = t.slice(0, len(t) - tail), t.slice(len(t) - tail)
            if len(t):
                for part in _page_boxes(t, near):
                    full = {f.name: part[f.name] if f.name in part.column_names else pa.nulls(len(part), f.type) for f in schema}
                    yield from pa.table(full, schema=schema).to_batches()

    return run


def drawn_tables(segments: DataFrame, near: float = NEAR) -> DataFrame:
    """page_id, x0, y0, x1, y1, lines, confidence: the box of each group of touching lines that has both kinds, and sides over LEAST_SIDE.

    segments: page_id, segment_id, kind (h or v), x0, y0, x1, y1. Lines touch through others, so a grid is one table however
    large, and two grids on a page are two. Pages of up to AT_ONCE lines are read one after another; what they hold needs no
    other page. Larger ones, and odd rows, are joined on a grid and grouped in rounds.
    """
    kind = {f.name: f for f in segments.schema}
    out = StructType([kind[c] for c in SEGMENT]).add("lines", "long").add("kinds", "long")
    for f in out:
        f.nullable = True
    together = segments.select(*SEGMENT, F.count("*").over(Window.partitionBy("page_id")).alias("_n"))
    found = saved(together.mapInArrow(_by_page(near, to_arrow_schema(out)), out), "page-boxes")
    boxes, rest = found.where("lines is not null").select("page_id", *BOX, "lines", "kinds"), found.where("lines is null").select(*SEGMENT)
    return _tables(boxes if rest.isEmpty() else boxes.unionByName(_joined_boxes(rest, near)))


def _joined_boxes(segments: DataFrame, near: float) -> DataFrame:
    """page_id, box, lines and kinds of groups of touching lines, on pages of any size."""
    c = components(touching(segments, near)).select(F.col("node.page_id").alias("page_id"), F.col("node.segment_id").alias("segment_id"), F.col("component.segment_id").alias("component"))
    x = segments.join(c, ["page_id", "segment_id"])
    g = x.groupBy("page_id", "component").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("lines"), F.count_distinct("kind").alias("kinds"))
    return g.drop("component")


def _tables(boxes: DataFrame) -> DataFrame:
    big = (F.col("x1") - F.col("x0") > LEAST_SIDE) & (F.col("y1") - F.col("y0") > LEAST_SIDE)
    return boxes.where(big & (F.col("kinds") == 2)).select("page_id", "x0", "y0", "x1", "y1", "lines", F.lit(DRAWN).alias("confidence"))


def page_tables(segments: DataFrame) -> DataFrame:
    """page_id, x0, y0, x1, y1, confidence: one box around all lines of a page that has both kinds, where its sides are over LEAST_SIDE."""
    g = segments.groupBy("page_id").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count_distinct("kind").alias("kinds"))
    big = (F.col("x1") - F.col("x0") > LEAST_SIDE) & (F.col("y1") - F.col("y0") > LEAST_SIDE)
    return g.where(big & (F.col("kinds") == 2)).select("page_id", "x0", "y0", "x1", "y1", F.lit(DRAWN).alias("confidence"))
