"""The trie of conversations, by van Emde Boas recursion.

Sequences of up to 2^k turns are cut at half depth. The first halves make the upper trie; each different one is a cut
prefix with a name, and what follows it is a sequence of the lower trie that hangs below that name. Both are cut again,
until sequences are single turns: a turn below a name is a node. All tries of one height, upper and lower, are one table, and
are cut in one job, so there are k rounds for 2^k turns and no task follows a conversation from end to end.

Totals are grafted upward, height by height: what the lower tries hold is added to the node that they hang from, and to
that node's ancestors within its own upper trie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

#: Conversations share the first turns of the one whose id is theirs rounded down to a multiple of FAMILY; fewer than SHARED of them.
FAMILY, SHARED = 100, 6


def _name(*parts) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos from 0, token (a digest of role and text), points (code points of the text).

    Ordered by turn, null first; turns that share a number by the digest. Rows are sorted by range, so that a conversation of
    any length is spread over tasks; a task's rows get their places from how many rows of theirs are in the tasks before it.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    t = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", _name(F.length(role).cast("string"), F.lit(":"), role, text).alias("token"), F.length(text).alias("points"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "token"]
    t = t.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "token", "points", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    t = stored(t, "turns")
    parts = t.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("at").alias("from"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", (F.col("from") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("zero"))
    return t.join(parts, ["conv_id", "part"]).select("conv_id", (F.col("at") - F.col("zero")).alias("pos"), "token", "points")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv_id, n_turns), and their turns (conv_id, depth from 1, token, points) after the first ones are shared."""
    own = stored(turns(conversations), "own-turns")
    head = own.where(f"pos < {SHARED - 1} and conv_id % {FAMILY} = 0").groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("pos", "token", "points"))).alias("head"))
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    ids = own.groupBy("conv_id").agg(F.count("*").alias("n_own")).withColumns({"h": shared, "base": F.expr(f"conv_id - conv_id % {FAMILY}")})
    ids = ids.join(head, "base", "left").withColumn("head", F.when(F.col("h") > 0, F.slice("head", 1, F.col("h").cast("int"))))
    ids = stored(ids.select("conv_id", "h", "head", F.greatest(F.coalesce(F.size("head"), F.lit(0)), F.lit(0)).alias("lent"), (F.col("n_own") - F.least("n_own", "h")).alias("kept")), "conversations")
    lent = ids.select("conv_id", F.posexplode("head").alias("i", "t")).select("conv_id", (F.col("i") + 1).cast("long").alias("depth"), "t.token", "t.points")
    rest = own.join(ids.select("conv_id", "h", "lent"), "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("lent") + 1).alias("depth"), "token", "points")
    return ids.select("conv_id", (F.col("lent") + F.col("kept")).alias("n_turns")), stored(lent.unionByName(rest), "rebuilt")


def named(sequences: DataFrame, tokens: DataFrame, height: int) -> DataFrame:
    """For each conversation and depth from 0 on the name of its turns so far, by cutting sequences of `height`, a power of two above all lengths."""
    halves, size = {1: tokens.select("conv_id", (F.col("depth") - 1).alias("block"), F.col("token").alias("content"))}, 1
    while size * 2 < height:  # contents of all whole blocks of each size
        pair = halves[size].groupBy("conv_id", F.expr("block div 2").alias("block")).agg(F.count("*").alias("n"), F.min_by("content", "block").alias("l"), F.max_by("content", "block").alias("r"))
        size *= 2
        halves[size] = stored(pair.where("n = 2").select("conv_id", "block", _name("l", "r").alias("content")), "blocks")
    pieces = sequences.select("conv_id", "n_turns", F.lit(0).cast("long").alias("block"), F.lit(b"").alias("name"))
    while height > 1:
        height //= 2
        first = halves[height].where("block % 2 = 0").select("conv_id", F.expr("block div 2").alias("block"), "content")
        x = pieces.join(first, ["conv_id", "block"], "left")
        second = F.col("block") * 2 + 1
        below = F.when(second * height <= F.col("n_turns"), F.struct(second.alias("block"), _name("name", "content").alias("name")))
        two = F.array_compact(F.array(F.struct((F.col("block") * 2).alias("block"), F.col("name").alias("name")), below))
        pieces = stored(x.select("conv_id", "n_turns", F.explode(two).alias("p")).select("conv_id", "n_turns", "p.*"), "pieces")
    return pieces.withColumnRenamed("block", "depth")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by name and conv_id: one digest runs over the ids of a name, however many."""
    last, sha = None, None

    def told():
        return pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([sha.hexdigest()])], names=["name", "ends_sha256"])

    for b in batches:
        for name, conv in zip(b["name"].to_pylist(), b["conv_id"].to_pylist(), strict=True):
            if name != last:
                if sha is not None:
                    yield told()
                last, sha = name, hashlib.sha256(b"%d" % conv)
            else:
                sha.update(b",%d" % conv)
    if sha is not None:
        yield told()


def _grafted(nodes: DataFrame, names: DataFrame, height: int) -> DataFrame:
    """name, leaves and saved of whole subtrees, from those of nodes (name, above, above_conv, depth, leaves, saved) alone."""
    total, size = nodes, 1
    while size < height:
        block = F.expr(f"(depth - 1) div {size}")
        lower = total.where((F.col("depth") - 1) % size == 0).where(block % 2 == 1)
        hung = lower.groupBy("above", "above_conv", (block - 1).alias("block")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        if size == 1:
            more = hung.select(F.col("above").alias("name"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
        else:  # the path to where they hang is that of any conversation that goes there
            path = names.select(F.col("conv_id").alias("above_conv"), block.alias("block"), "name")
            more = hung.join(path, ["above_conv", "block"]).groupBy("name").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        x = total.join(more, "name", "left")
        total = stored(x.select(*[c for c in total.columns if c not in ("leaves", "saved")], *[(F.col(c) + F.coalesce(m, F.lit(0))).alias(c) for c, m in (("leaves", "l"), ("saved", "s"))]), "totals")
        size *= 2
    return total


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts count as empty; rows without conv_id belong to no conversation and are left out. Turns are ordered
    by number, null first, those with one number by the MD5 of role and text; rows that are repeated are turns of their own.
    Conversations without turns are members of the root alone. An empty table has no root. Other columns are ignored.
    """
    sequences, tokens = rebuilt(conversations)
    deepest = sequences.agg(F.max("n_turns")).first()[0]
    if deepest is None:
        return conversations.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    height = 1 << deepest.bit_length()
    names = named(sequences, tokens, height)
    node = stored(names.groupBy("name").agg(F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")), "nodes")
    above = names.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("above"))
    node = node.join(above, ["conv_id", "depth"], "left").join(tokens.select("conv_id", "depth", "points"), ["conv_id", "depth"], "left")
    node = stored(node, "nodes-above")
    children = node.groupBy(F.col("above").alias("name")).agg(F.count("*").alias("n_children"))
    ends = names.where("depth = n_turns").select("conv_id", "name").repartition("name").sortWithinPartitions("name", "conv_id").mapInArrow(_ends, "name binary, ends_sha256 string")
    parent = node.select(F.col("name").alias("above"), F.col("conv_id").alias("above_conv"))
    x = node.join(children, "name", "left").join(parent, "above", "left").join(ends, "name", "left")
    x = stored(x.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie")
    own = x.where("depth > 0").select("name", "above", "above_conv", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("points")).alias("saved"))
    total = _grafted(own, names, height).select("name", "above", "leaves", "saved")
    top = total.where(F.col("above") == F.lit(b"")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    top = top.select(F.lit(b"").alias("name"), F.coalesce("leaves", F.lit(1)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"))
    out = x.join(total.drop("above").unionByName(top), "name")
    return out.select("conv_id", "depth", F.col("above_conv").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda a: ascii(a)::bigint), lambda v, a: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda w, i: CASE WHEN w % 2 = 1 THEN xor(w // 2, 3988292384) ELSE w // 2 END, xor(v, a)), 4294967295::bigint), 4294967295) % 6 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
rb AS (SELECT c.conv_id, 0 AS k, t.pos, r, x FROM c JOIN t ON t.conv_id = base AND t.pos < h UNION ALL SELECT c.conv_id, 1, t.pos, r, x FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= h),
sq AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY k, pos) AS depth, md5(length(r) || ':' || r || x) AS token, length(x) AS points FROM rb),
ps AS (SELECT c.conv_id, coalesce(list(token ORDER BY depth) FILTER (token IS NOT NULL), []) AS a, coalesce(list(points ORDER BY depth) FILTER (token IS NOT NULL), []) AS p FROM c LEFT JOIN sq USING (conv_id) GROUP BY c.conv_id),
nm AS (SELECT conv_id, len(a) AS n, unnest(range(0, len(a) + 1)) AS depth, a, p FROM ps),
nd AS (SELECT a[:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(p[depth]) AS points,
              sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM nm GROUP BY ALL),
ch AS (SELECT path[:-2] AS path, count(*) AS n_children FROM nd WHERE depth > 0 GROUP BY ALL),
st AS (SELECT n.path, n.depth, n.conv_id, n.n_convs, n.ends_sha256, coalesce(n_children, 0) AS n_children, (n.n_convs - 1) * coalesce(points, 0) AS own FROM nd n LEFT JOIN ch USING (path)),
up AS (SELECT path[:d] AS path, sum((n_children = 0)::bigint)::bigint AS n_leaves, sum(own)::bigint AS saved_tokens FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM st) GROUP BY ALL)
SELECT st.conv_id, st.depth::bigint AS depth, par.conv_id AS parent_conv_id, st.n_convs, st.n_children, n_leaves, saved_tokens, st.ends_sha256
FROM st JOIN up USING (path) LEFT JOIN nd par ON st.depth > 0 AND par.path = st.path[:-2]
"""
