"""The most frequent trigrams of texts, counted where a text lies: rows of one text need no other."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from foliant.functions.text import characters, trigrams
from foliant.sources.scratch import saved

#: Keys that repeat, up to which they are broadcast; beyond, their rows are joined by shuffles.
FEW = 100_000
TOP = "array<struct<t:string,n:bigint>>"


@cache
def _folded() -> np.ndarray:
    """By code point its lower case, 0 for those that are no letter or digit then; made once in a worker."""
    low = np.zeros(0x110000, np.int64)
    for i in range(0x110000):
        c = chr(i).lower()  # one character, but for a dotted capital i, whose dot is no letter
        if len(c) == 1 and (unicodedata.category(c)[0] == "L" or unicodedata.category(c) == "Nd"):
            low[i] = ord(c)
    return low


def _top(text: str, k: int, folded: bool) -> list[tuple[str, int]]:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if len(c) < 3:
        return []
    c = _folded()[c] if folded else c
    code = c[:-2] << 42 | c[1:-1] << 21 | c[2:]
    if folded:
        code = code[(c[:-2] > 0) & (c[1:-1] > 0) & (c[2:] > 0)]  # what goes leaves the order of the others
    t, first, n = np.unique(code, return_index=True, return_counts=True)
    best = np.lexsort((first, -n))[:k]
    return [("".join(chr(int(x) >> s & 0x1FFFFF) for s in (42, 21, 0)), int(m)) for x, m in zip(t[best], n[best], strict=True)]


def _counted(k: int, folded: bool, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            top = [[{"t": t, "n": n} for t, n in _top(x.as_py().decode("utf-8", "replace"), k, folded)] if x.is_valid else [] for x in b["_text"]]
            yield pa.RecordBatch.from_arrays([*[b[c] for c in schema.names[:-1]], pa.array(top, schema.field("top").type)], schema=schema)

    return run


def _by_key(rows: DataFrame, key: str, k: int, folded: bool) -> DataFrame:
    """key and top of texts of which several share a key: their trigrams meet by key, and are counted together."""
    c = characters(F.col("_text").cast("string"))
    g = rows.select(key, (F.transform(c, F.lower) if folded else c).alias("c")).select(key, F.posexplode(trigrams("c")).alias("i", "t"))
    g = g.where(F.col("t").rlike(r"^[\p{L}\p{Nd}]{3}$")) if folded else g
    g = g.groupBy(key, "t").agg(F.count("*").alias("n"), F.min("i").alias("i"))
    g = g.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "i"))).where(F.col("r") <= k)
    top = F.transform(F.array_sort(F.collect_list(F.struct("r", "t", "n"))), lambda v: F.struct(v["t"].alias("t"), v["n"].alias("n")))
    return g.groupBy(key).agg(top.alias("top"))


def with_top(df: DataFrame, key: str, text: str, k: int, folded: bool = False, each: bool = True, keys: DataFrame | None = None) -> DataFrame:
    """df with `top` in place of its column text: the k most frequent trigrams of text and their numbers, of equals the first seen first; texts that share a key count together.

    folded: in lower case, and of letters and digits alone. Of keys that repeat the trigrams are gathered, of others nothing moves.
    each: every row of such a key has its trigrams; else the key has one row, with no column besides that has a value. keys: the keys of df alone, where they are had for less.
    """
    rows = df.withColumn("_text", F.col(text).cast("binary")).drop(text)
    schema = StructType([f for f in rows.schema if f.name != "_text"]).add("top", ArrayType(StructType().add("t", "string").add("n", "long")))
    repeated = saved((df if keys is None else keys).groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(F.col(key).alias("_key")), "repeated-keys")
    many = repeated.limit(FEW + 1).count()
    if not many:
        return rows.mapInArrow(_counted(k, folded, to_arrow_schema(schema)), schema)
    marked = F.broadcast(repeated) if many <= FEW else repeated
    same = F.col(key).eqNullSafe(F.col("_key"))
    once = rows.join(marked, same, "left_anti").mapInArrow(_counted(k, folded, to_arrow_schema(schema)), schema)
    several = rows.join(marked, same, "left_semi")
    top = _by_key(several, key, k, folded).withColumnRenamed(key, "_key")
    if not each:
        return once.unionByName(top.withColumnRenamed("_key", key), allowMissingColumns=True)
    more = several.drop("_text").join(top, same, "left").select(*schema.names[:-1], F.coalesce("top", F.array().cast(TOP)).alias("top"))
    return once.unionByName(more)
