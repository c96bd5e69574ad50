"""Similarity join of documents on the Jaccard similarity of their word n-gram sets.

1. Every text becomes the set of its 5-word shingles (64-bit hashes) and MinHash bands; band and row counts are chosen
   for a target recall at the threshold. Texts with one shingle set form a class of copies with one representative.
2. Representatives are shuffled on band hashes; bands with two or more are buckets, and buckets that share members form a
   candidate cluster (labels move along bands until nothing changes, over written tables).
3. Pairs are verified on full shingle sets, block against block, so that a group of any size becomes many bounded tasks;
   blocks are bounded in documents and in shingles. A pair is one to verify when it shares a bucket, whatever the size of
   its cluster. A cluster is verified bucket by bucket, a pair in the first bucket that it shares, or as a whole, pairs
   without a bucket left out, where its buckets overlap so much that this moves less: which of the two is a matter of
   cost only. Long chains of texts so cost in proportion to their buckets, dense clusters the square of their different
   texts. No pair is emitted, only each document's number of links and a spanning forest.
4. The forests' components are the classes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, small, stored, table, text_of, text_slices

N, THRESHOLD, RECALL, MOST_HASHES = 5, 0.8, 0.9999, 192
#: Documents and shingles in a verification block, about; a task holds two blocks.
BLOCK, BLOCK_SHINGLES = 256, 1_000_000
#: Candidate documents whose ids and clusters may be broadcast to the second reading of the texts.
BROADCAST_DOCS = 300_000

_U = np.uint64
_WS = np.zeros(256, bool)
_WS[[32, 9, 10, 11, 12, 13]] = True
_rng = np.random.default_rng(20_240_229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE = _BYTE[_LOWER]  # A-Z count as a-z
_R = _U(0x9E3779B97F4A7C15)
_R_INV = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_COEF = _rng.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_A = _rng.integers(1, 2**63, 1024, dtype=np.uint64) * _U(2) + _U(1)
_B = _rng.integers(1, 2**63, 1024, dtype=np.uint64)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band can have so that pairs at the threshold are found with the recall asked for."""
    for rows in range(32, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no banding within the number of hashes reaches the recall")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POW: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW[0]) < n:
        size = max(n, 1 << 20)
        out = []
        for r in (_R, _R_INV):
            p = np.full(size, r, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POW[:] = out
    return _POW[0][:n], _POW[1][:n]


def shingle_sets(texts: list[bytes], n: int = N) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text (A-Z lower-cased, words between white space).

    A text of 1 to n - 1 words has one shingle, all its words; a text without words has none.
    """
    for t in texts:
        b = np.frombuffer(t, np.uint8)
        space = _WS[b]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
        start, stop = edge[::2], edge[1::2]
        k = len(start)
        if not k:
            yield np.zeros(0, np.uint64)
            continue
        up, down = _powers(len(b) + 1)
        cum = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTE[b] * up[:-1], out=cum[1:])
        word = _mix((cum[stop] - cum[start]) * down[start] + (stop - start).astype(np.uint64))
        m = min(n, k)
        h = np.zeros(k - m + 1, np.uint64)
        for j in range(m):
            h += word[j : k - m + 1 + j] * _COEF[j]
        yield np.unique(_mix(h + _U(m)))


def _set_id(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def min_hash(shingles: np.ndarray, hashes: int) -> np.ndarray:
    out = np.full(hashes, np.iinfo(np.uint64).max, np.uint64)
    a, b = _A[:hashes, None], _B[:hashes, None]
    for at in range(0, len(shingles), 512):
        np.minimum(out, (shingles[None, at : at + 512] * a + b).min(axis=1), out=out)
    return out


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band; the band's number is part of it."""
    x = np.arange(1, bands + 1, dtype=np.uint64)
    for j in range(rows):
        x = _mix(x * _R + sig[: bands * rows].reshape(bands, rows)[:, j])
    return x.view(np.int64)


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_key, set_id (digest of the shingle set; null for none), shingles (their number), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at, size in text_slices(whole["text"], 2_000):
                b = whole.slice(at, size)
                ids, sizes, keys, seen = [], [], [], {}
                for s in shingle_sets([(t or "").encode() for t in b["text"].to_pylist()], n):
                    ids.append(d := _set_id(s))
                    sizes.append(len(s))
                    if d not in seen:
                        seen[d] = band_hashes(min_hash(s, bands * rows), bands, rows) if len(s) else []
                    keys.append(seen[d])
                yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_key"], pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "text_key", "set_id", "shingles", "bands"])

    return docs.mapInArrow(run, "doc_id long, text_key long, set_id binary, shingles long, bands array<long>")


def components(links: DataFrame, name: str) -> DataFrame:
    """Connected components of links (node, hub): node, label (the smallest node that it is connected with).

    Labels move from nodes to hubs and back; then every node takes its label's label, so that the rounds grow with the
    logarithm of a component's diameter. Each round is written, none is held on the driver.
    """
    links = stored(links.select("node", "hub").distinct(), f"{name}-links")
    labels = stored(links.groupBy("hub").agg(F.min("node").alias("low")).join(links, "hub").groupBy("node").agg(F.min("low").alias("label")), f"{name}-labels")
    while True:
        hubs = links.join(labels, "node").groupBy("hub").agg(F.min("label").alias("low"))
        near = links.join(hubs, "hub").groupBy("node").agg(F.min("low").alias("low"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = labels.select("node", "label").join(near, "node").join(jump, "label", "left")
        new = stored(step.select("node", F.least("label", "low", F.coalesce("far", "label")).alias("label"), (F.least("low", F.coalesce("far", "label")) < F.col("label")).alias("moved")), f"{name}-labels")
        release(labels)
        labels = new
        if not new.where("moved").limit(1).count():
            release(links)
            return labels.select("node", "label")


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many members sets[i] and sets[j] share, for every i of left and j of right."""
    size = [len(s) for s in sets]
    common = np.zeros((len(left), len(right)), np.float32)
    if not sum(size):
        return common
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times > 1
    column = np.cumsum(often) - 1
    owner = np.repeat(np.arange(len(sets)), size)
    hit = often[code]
    col, own = column[code[hit]], owner[hit]
    order = np.argsort(col, kind="stable")
    col, own = col[order], own[order]
    place_l, place_r = np.full(len(sets), -1), np.full(len(sets), -1)
    place_l[left], place_r[right] = np.arange(len(left)), np.arange(len(right))
    width = 8192
    for lo in range(0, int(often.sum()), width):
        a, b = np.searchsorted(col, (lo, lo + width))
        c, o = col[a:b] - lo, own[a:b]
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        il, ir = place_l[o] >= 0, place_r[o] >= 0
        x[place_l[o][il], c[il]] = 1
        y[place_r[o][ir], c[ir]] = 1
        common += x @ y.T
    return common


def verify_block(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, same: bool, threshold: float, sooner: list[np.ndarray] | None = None, buckets: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of positions with Jaccard at least the threshold; i from left, j from right (i < j when they are the same).

    Pairs that share a bucket in `sooner` are left to that bucket; with `buckets`, pairs that share none of them are left out.
    """
    size = np.array([len(s) for s in sets])
    common = shared_counts(sets, left, right)
    either = size[left][:, None] + size[right][None, :] - common
    ok = common >= threshold * either - 1e-6
    if same:
        ok &= np.triu(np.ones(ok.shape, bool), 1)
    if sooner is not None and ok.any():
        ok &= shared_counts(sooner, left, right) == 0
    if buckets is not None and ok.any():
        ok &= shared_counts(buckets, left, right) > 0
    i, j = np.nonzero(ok)
    return left[i], right[j]


def _verified(placed: DataFrame, threshold: float) -> DataFrame:
    """placed: cluster, block_a, block_b, node, block, copies, shingles, sooner, buckets (null where the cluster is a bucket). Rows: node, n_near (copies of linked texts), n_texts, hub."""

    def run(key, t):
        nodes = t["node"].to_pylist()
        pick = list({x: i for i, x in reversed(list(enumerate(nodes)))}.values())  # rows that repeat an id and its text
        t, nodes = t.take(pick), [nodes[i] for i in pick]
        same, n = key[1].as_py() == key[2].as_py(), len(nodes)
        copies, block = t["copies"].to_numpy(), t["block"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in t["shingles"].to_pylist()]
        left = np.flatnonzero(block == key[1].as_py())
        right = left if same else np.flatnonzero(block == key[2].as_py())
        near, texts, hub = np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)
        if len(left) and len(right):
            shared = lambda c: [np.array(x, np.int64) for x in t[c].to_pylist()]
            whole = t["buckets"][0].is_valid
            i, j = verify_block(sets, left, right, same, threshold, None if whole else shared("sooner"), shared("buckets") if whole else None)
            for a, b in ((i, j), (j, i)):
                near += np.bincount(a, copies[b], n).astype(np.int64)
                texts += np.bincount(a, minlength=n)
            while True:  # the first member of each component of these blocks becomes its hub
                low = hub.copy()
                np.minimum.at(low, i, hub[j])
                np.minimum.at(low, j, hub[i])
                low = np.minimum(low, low[low])
                if (low == hub).all():
                    break
                hub = low
        linked = np.flatnonzero(texts > 0)
        return pa.table({"node": pa.array([nodes[i] for i in linked], pa.binary()), "n_near": near[linked], "n_texts": texts[linked], "hub": pa.array([nodes[hub[i]] for i in linked], pa.binary())})

    return placed.groupBy("cluster", "block_a", "block_b").applyInArrow(run, "node binary, n_near long, n_texts long, hub binary")


def _blocks(members: str, shingles: str):
    return F.greatest(F.ceil(F.col(members) / BLOCK), F.ceil(F.col(shingles) / BLOCK_SHINGLES)).cast("int")


def _members(reps: DataFrame) -> DataFrame:
    """Candidates among reps (node, rep_id, copies, shingles, bands): node, rep_id, copies, places.

    A place says with whom a node is verified: cluster (a label or a bucket), its number of blocks, the node's block, the
    buckets of the node that come sooner, and in a whole cluster all its buckets. A node has as many places as bands at most.
    """
    banded = reps.select("node", "shingles", F.explode("bands").alias("hub"))
    shared = banded.groupBy("hub").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("hub")
    links = stored(banded.join(shared, "hub").select("node", "shingles", "hub"), "bands")
    label = stored(components(links, "bands").join(reps.select("node", "rep_id", "copies", "shingles"), "node"), "clusters")
    cluster = label.groupBy("label").agg(F.count("*").alias("members"), F.sum("shingles").alias("all")).withColumn("blocks", _blocks("members", "all"))
    # buckets of clusters that take several blocks; of buckets with the same members one is enough
    large = label.join(cluster.where("blocks > 1").select("label"), "label").select("node", "label")
    bucket = links.join(large, "node").groupBy("label", "hub").agg(F.count("*").alias("members"), F.sum("shingles").alias("all"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.sum(F.shiftright(F.xxhash64("node"), 24)).alias("sum"))
    bucket = bucket.groupBy("label", "members", "all", "lo", "hi", "sum").agg(F.min("hub").alias("hub")).withColumn("blocks", _blocks("members", "all"))
    bucket = stored(bucket.select("label", "hub", "all", "blocks"), "buckets")
    cost = bucket.groupBy("label").agg(F.sum(F.col("all") * F.col("blocks")).alias("apart"))
    cluster = stored(cluster.join(cost, "label", "left").select("label", "blocks", F.coalesce(F.col("apart") < F.col("all") * F.col("blocks"), F.lit(False)).alias("by_bucket")), "cluster-blocks")
    at = lambda blocks: F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int").alias("block")
    none = F.lit(None).cast("array<bigint>")
    whole = label.join(cluster.where("not by_bucket"), "label").join(links.groupBy("node").agg(F.collect_set("hub").alias("buckets")), "node")
    whole = whole.select("node", "rep_id", "copies", F.array(F.struct(F.col("label").alias("cluster"), "blocks", at("blocks"), none.alias("sooner"), "buckets")).alias("places"))
    apart = links.select("node", "hub").join(bucket.join(cluster.where("by_bucket").select("label"), "label").select("hub", "blocks"), "hub")
    hubs = apart.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("hub", "blocks", at("blocks")))).alias("hubs"))
    place = lambda x, i: F.struct(F.unhex(F.hex(x["hub"])).alias("cluster"), x["blocks"].alias("blocks"), x["block"].alias("block"), F.transform(F.slice("hubs", 1, i), lambda y: y["hub"]).alias("sooner"), none.alias("buckets"))
    apart = label.join(hubs, "node").select("node", "rep_id", "copies", F.transform("hubs", place).alias("places"))
    return whole.unionByName(apart)


def ngram_join(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per input row: doc_id, text_key, rep_id, class_id, n_copies, n_links, n_texts, kept.

    Documents are linked when the Jaccard similarity of their sets of n-word shingles is at least the threshold (A-Z
    count as a-z; words lie between white space; texts of fewer than n words have one shingle, all their words).
    rep_id is the smallest doc_id with the same shingle set and n_copies how many rows have it; n_links counts the
    other rows linked to this one, copies included; n_texts the different shingle sets. Linked documents, directly or
    through others, form a class named by its smallest doc_id; the row with that id is kept. Null, empty and
    white-space texts have no shingles: no links, each its own class. A null doc_id is largest. Rows that repeat a
    doc_id are compared one by one; those in one class with its smallest doc_id are all kept. An empty table gives an
    empty result. Columns other than doc_id and text are ignored.
    """
    return _joined(docs, n, threshold, recall).drop("class_node")


def _joined(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """ngram_join with class_node, which tells classes apart that have one class_id; null without shingles."""
    bands, rows = choose_bands(threshold, recall)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_key"), text_of().alias("text"))
    sig = stored(signatures(texts, n, bands, rows), "signatures")
    reps = sig.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("rep_id"), F.count("*").alias("copies"), F.first("shingles").alias("shingles"), F.first("bands").alias("bands"))
    reps = stored(reps.withColumnRenamed("set_id", "node"), "reps")
    member = stored(_members(reps), "members")
    again = texts.join(small(member, BROADCAST_DOCS), texts.doc_id.eqNullSafe(member.rep_id)).select("node", "copies", "places", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at, size in text_slices(whole["text"], 2_000):
                b = whole.slice(at, size)
                s = list(shingle_sets([(t or "").encode() for t in b["text"].to_pylist()], n))
                own = [i for i, (x, node) in enumerate(zip(s, b["node"].to_pylist(), strict=True)) if _set_id(x) == node]  # another text may have the id
                b = b.take(pa.array(own, pa.int32()))
                yield pa.RecordBatch.from_arrays([b[c] for c in ("node", "copies", "places")] + [pa.array([s[i].tobytes() for i in own], pa.binary())], names=["node", "copies", "places", "shingles"])

    full = again.mapInArrow(sets, f"node binary, copies long, places {member.schema['places'].dataType.simpleString()}, shingles binary")
    # a row for each block that this one meets
    met = full.select("node", "copies", "shingles", F.explode("places").alias("p")).select("*", F.explode(F.sequence(F.lit(0), F.col("p.blocks") - 1)).alias("other"))
    placed = met.select(F.col("p.cluster").alias("cluster"), F.least("p.block", "other").alias("block_a"), F.greatest("p.block", "other").alias("block_b"), "node", F.col("p.block").alias("block"), "copies", "shingles", F.col("p.sooner").alias("sooner"), F.col("p.buckets").alias("buckets"))
    found = stored(_verified(placed, threshold), "verified")
    classes = components(found.select("node", "hub").unionByName(found.select(F.col("hub").alias("node"), "hub")), "classes")
    counts = found.groupBy("node").agg(F.sum("n_near").alias("n_near"), F.sum("n_texts").alias("n_texts"))
    linked = classes.join(counts, "node", "left").join(reps.select("node", "rep_id"), "node")
    named = linked.groupBy("label").agg(F.min("rep_id").alias("class_id"))
    linked = linked.join(named, "label").select("node", F.col("label").alias("class_node"), "class_id", "n_near", "n_texts")
    of_set = reps.select("node", "rep_id", "copies").join(linked, "node", "left")
    x = sig.select("doc_id", "text_key", "set_id").join(of_set, sig.set_id == of_set.node, "left")
    none = F.col("set_id").isNull()
    class_id = F.when(none, F.col("doc_id")).otherwise(F.coalesce("class_id", "rep_id"))
    x = x.select(
        "doc_id",
        "text_key",
        F.when(none, F.col("doc_id")).otherwise(F.col("rep_id")).alias("rep_id"),
        class_id.alias("class_id"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("n_copies"),
        (F.coalesce("copies", F.lit(1).cast("long")) - 1 + F.coalesce("n_near", F.lit(0).cast("long"))).alias("n_links"),
        F.coalesce("n_texts", F.lit(0).cast("long")).alias("n_texts"),
        F.coalesce("class_node", "set_id").alias("class_node"),
    )
    return x.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def drop_near_copies(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs that ngram_join keeps, with all their columns, and of each class one row only.

    Of rows in one class that repeat its smallest doc_id the one with the smallest key of its text stays; of rows that
    repeat that text too, the first by all columns. Documents without shingles are no copies and all stay.
    """
    x = stored(_joined(docs, **how).select("doc_id", "text_key", "class_node", "kept"), "joined")
    key = F.struct("doc_id", "text_key")
    first = x.where("kept and class_node is not null").groupBy("class_node").agg(F.min(key).alias("first"), F.count("*").alias("n"))
    several = first.where("n > 1")
    other = x.where("kept").join(several, "class_node").where(~key.eqNullSafe(F.col("first"))).select("doc_id", "text_key")
    gone = x.where("not kept").select("doc_id", "text_key").unionByName(other).distinct()
    gone = small(stored(gone.withColumnsRenamed({"doc_id": "gone_id", "text_key": "gone_key"}), "gone"), BROADCAST_DOCS)
    twice = small(stored(several.select(F.col("first.doc_id").alias("twice_id"), F.col("first.text_key").alias("twice_key")), "twice"), BROADCAST_DOCS)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    x = row.withColumn("text_key", F.xxhash64(F.coalesce("row.text", F.lit(""))))
    x = x.join(gone, F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_key") == F.col("gone_key")), "left_anti")
    same = F.col("row.doc_id").eqNullSafe(F.col("twice_id")) & (F.col("text_key") == F.col("twice_key"))
    one = x.join(twice, same).groupBy("twice_id", "twice_key").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return x.join(twice, same, "left_anti").select("row.*").unionByName(one.select("row.*"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents")).drop("text_key")


#: All pairs by shared shingles; for tables small enough to join so.
ORACLE = r"""
WITH RECURSIVE a AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::varchar[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                          ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM a),
h AS (SELECT doc_id, s, CASE WHEN len(s) > 0 THEN md5(array_to_string(list_sort(s), chr(10))) END AS k FROM g),
r AS (SELECT k, min(doc_id) AS rep, count(*) AS copies, len(any_value(s)) AS n, any_value(s) AS s FROM h WHERE k IS NOT NULL GROUP BY k),
x AS (SELECT rep, n, copies, unnest(s) AS t FROM r),
p AS (SELECT a.rep AS a, b.rep AS b, b.copies AS c FROM x a JOIN x b ON a.t = b.t AND a.rep <> b.rep
      GROUP BY a.rep, b.rep, a.n, b.n, b.copies HAVING count(*) >= 0.8 * (a.n + b.n - count(*))),
c(node, low) AS (SELECT rep, rep FROM r UNION SELECT p.b, c.low FROM c JOIN p ON p.a = c.node),
cl AS (SELECT node, min(low) AS class_id FROM c GROUP BY node),
l AS (SELECT a, sum(c) AS near, count(*) AS texts FROM p GROUP BY a)
SELECT doc_id, coalesce(r.rep, doc_id) AS rep_id, coalesce(class_id, doc_id) AS class_id, coalesce(copies, 1)::bigint AS n_copies,
       (coalesce(copies, 1) - 1 + coalesce(near, 0))::bigint AS n_links, coalesce(texts, 0)::bigint AS n_texts, doc_id = coalesce(class_id, doc_id) AS kept
FROM h LEFT JOIN r USING (k) LEFT JOIN cl ON cl.node = r.rep LEFT JOIN l ON l.a = r.rep
"""
