"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions, so each of the 255 inner nodes of the byte's decision tree has a context tree of its
own over the preceding bytes, the nearest first. Every node estimates its bit after Krichevsky and Trofimov; weighting
mixes, for each bit, the estimates of all depths along the path, half for stopping at a node and half for its children,
in the proportion in which they explained the training text.

The Krichevsky-Trofimov probability of a node depends on its counts alone, so training is counting: one aggregation
of all training bytes with the contexts before them. Every context that the training text has is kept, however rare,
so the model grows with the corpus. It is never gathered in one place: groups of contexts of three bytes are weighted
together, each distinct gram gets its probability there, and chunks of texts are joined to their grams.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import stored, table

DEPTH = 5
#: A byte that UTF-8 never has: before the first byte and after the last.
END = 255
#: Bytes of text counted at once, and bytes of text whose grams and words are looked up together.
CHUNK, LOOKUP = 2_000_000, 16_000_000
#: Bytes of text for each bucket that grams and words are dealt to, and how many buckets there are at least.
BUCKET, LEAST_BUCKETS = 32_000_000, 64
#: Distinct grams weighted at once, and for each group of contexts that a task weighs.
SLICE, GROUP = 200_000, 300_000

# ---------------------------------------------------------------- counting


def _joined(texts: list[bytes], depth: int) -> np.ndarray:
    pad = bytes([END]) * depth
    return np.frombuffer(b"".join([x for t in texts for x in (pad, t, bytes([END]))]), np.uint8)


def _grams(b: np.ndarray, depth: int) -> np.ndarray:
    """Each byte that is not padding, with the `depth` bytes before it above it."""
    n = len(b) - depth
    g = np.zeros(max(n, 0), np.uint64)
    for k in range(depth + 1):
        g = (g << np.uint64(8)) | b[k : n + k].astype(np.uint64)
    return g


def text_grams(texts: list[bytes], depth: int) -> np.ndarray:
    """The grams of all texts; a text of n bytes has n + 1."""
    g = _grams(_joined(texts, depth), depth)
    if len(texts) > 1:
        drop = np.ones(len(g), bool)
        at = np.cumsum([len(t) + 1 + depth for t in texts[:-1]]) - depth
        for k in range(depth):
            drop[at + k] = False
        g = g[drop]
    return g


def _merge(a: tuple[np.ndarray, np.ndarray] | None, g: np.ndarray, weight: int = 1) -> tuple[np.ndarray, np.ndarray]:
    u, n = np.unique(g, return_counts=True)
    n = n * weight
    if a is None:
        return u, n
    key = np.concatenate((a[0], u))
    order = np.argsort(key, kind="stable")
    key, val = key[order], np.concatenate((a[1], n))[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    return key[new], np.add.reduceat(val, np.flatnonzero(new))


def _batches(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of lower-cased texts of about CHUNK bytes, with the place of the first."""
    at, size, run = 0, 0, []
    for i, t in enumerate(t for lo in range(0, len(column), 500) for t in column.slice(lo, 500).to_pylist()):
        t = (t or "").encode().lower()
        run.append(t)
        size += len(t)
        if size > CHUNK:
            yield at, run
            at, size, run = i + 1, 0, []
    if run:
        yield at, run


def _bucket(gram: np.ndarray, buckets: int) -> np.ndarray:
    """Grams are dealt by the bytes furthest back, so that those of a bucket lie close together."""
    return ((((gram >> np.uint64(16)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _packed(x: np.ndarray) -> bytes:
    """Numbers below 2**56 as compressed planes of bytes, which are small where the numbers are."""
    return zstandard.compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T[:7]).tobytes(), 1)


def _unpacked(x: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(x), np.uint8).reshape(7, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :7] = planes.T
    return out.view("<u8").ravel()


def _grams_of(x: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(x), dtype=np.uint64)


def _words_of(x: bytes) -> list[bytes]:
    return zstandard.decompress(x).split(b"\n")


def _dealt(chunk: int, grams: tuple[np.ndarray, np.ndarray], buckets: int) -> Iterator[tuple]:
    """chunk, bucket, false, the grams of the bucket as steps from one to the next, and their training counts."""
    bucket = _bucket(grams[0], buckets)
    order = np.argsort(bucket, kind="stable")
    g, n, bucket = grams[0][order], grams[1][order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    for lo, hi in zip(cuts, [*cuts[1:], len(g)], strict=True):
        yield chunk, int(bucket[lo]), False, _packed(np.diff(g[lo:hi], prepend=np.uint64(0))), _packed(n[lo:hi])


def _dealt_words(chunk: int, words: dict[bytes, int], buckets: int) -> Iterator[tuple]:
    """chunk, bucket, true, the words of the bucket in order, and their training counts."""
    by = defaultdict(list)
    for w in words:
        by[zlib.crc32(w) % buckets].append(w)
    for bucket, some in by.items():
        some.sort()
        yield chunk, bucket, True, zstandard.compress(b"\n".join(some), 1), _packed(np.array([words[w] for w in some]))


def _summed(t: pa.Table) -> pa.Table:
    """gram and n of a bucket, from those of its chunks."""
    have, parts, size = None, [], 0
    rows = list(zip(t["asked"], t["times"], strict=True))
    for k, (g, n) in enumerate(rows):
        parts.append((_grams_of(g.as_py()), _unpacked(n.as_py()).astype(np.int64)))
        size += len(parts[-1][0])
        if size > 2_000_000 or k == len(rows) - 1:
            key, val = (np.concatenate(c) for c in zip(*([have] if have else []), *parts, strict=True))
            order = np.argsort(key, kind="stable")
            key, val = key[order], val[order]
            new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            have, parts, size = (key[new], np.add.reduceat(val, new)), [], 0
    return pa.table({"gram": have[0].view(np.int64), "n": have[1]})


def _counted(t: pa.Table) -> pa.Table:
    """For a bucket of words: each chunk's with their counts in all training text, and once how many there are."""
    total = defaultdict(int)
    for x, n in zip(t["asked"], t["times"], strict=True):
        for w, k in zip(_words_of(x.as_py()), _unpacked(n.as_py()).tolist(), strict=True):
            total[w] += k
    counts = [_packed(np.array([total[w] for w in _words_of(x.as_py())])) for x in t["asked"]]
    rest = [0] * (len(counts) - 1)
    return pa.table({"chunk": t["chunk"], "asked": t["asked"], "counts": pa.array(counts, pa.binary()), "different": [sum(n > 0 for n in total.values()), *rest], "tokens": [sum(total.values()), *rest]})


# ---------------------------------------------------------------- the tree

_NODE = np.array([[(256 | y) >> (8 - k) for k in range(8)] for y in range(256)])  # node of each bit of each byte
_BIT = np.array([[y >> (7 - k) & 1 for k in range(8)] for y in range(256)])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x >= 0.5, by Stirling's series above 8."""
    x = x.astype(float).copy()
    shift = np.zeros_like(x)
    for _ in range(8):
        low = x < 8
        shift[low] -= np.log(x[low])
        x[low] += 1
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def _kt(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ln of the block probability, probability that the next bit is one)."""
    block = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - math.log(math.pi) - _log_gamma(zeros + ones + 1)
    return block, (ones + 0.5) / (zeros + ones + 1)


def _key(gram: np.ndarray, d: int) -> np.ndarray:
    """(context of d bytes, node) at the eight decisions of each gram's byte, as one number each."""
    context = (gram >> np.uint64(8)) & np.uint64((1 << 8 * d) - 1)
    return (context[:, None] << np.uint64(8)) | _NODE[(gram & np.uint64(255)).astype(np.int64)].astype(np.uint64)


def _sums(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """The different keys, in order, and the sums of values at each."""
    u, at = np.unique(key, return_inverse=True)
    return [u, *(np.bincount(at, v, len(u)) for v in values)]


def _weigh(block: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ln of the weighted probability, share of stopping) from those of stopping and of going on."""
    weighted = np.logaddexp(block, split) - math.log(2)
    return weighted, np.exp(np.minimum(block - math.log(2) - weighted, 0.0))


class _Levels:
    """Contexts of low to depth bytes, with the nodes that the training text visits; others have probability one half."""

    __slots__ = ("edge", "levels")

    def __init__(self, gram: np.ndarray, n: np.ndarray, low: int, depth: int):
        self.levels = []
        ones = n[:, None] * _BIT[(gram & np.uint64(255)).astype(np.int64)]
        key, zero, one = _sums(_key(gram, depth).ravel(), (n[:, None] - ones).ravel(), ones.ravel())
        block, p = _kt(zero, one)
        weighted, stop = block, np.ones(len(key))
        for d in range(depth, low - 1, -1):
            self.levels.append((d, key, stop, p))
            self.edge = key, zero, one, weighted
            if d > low:
                key, zero, one, weighted, stop, p = above(*self.edge, d - 1)

    def ask(self, gram: np.ndarray) -> np.ndarray:
        """Probability that each decision of each gram's byte is as it is, as mixed by the context of `low` bytes."""
        q = np.full((len(gram), 8), 0.5)
        bit = _BIT[(gram & np.uint64(255)).astype(np.int64)] == 1
        for d, key, stop, p in self.levels:
            q = mixed(_key(gram, d), bit, key, stop, p, q)
        return q


def _up(key: np.ndarray, d: int) -> np.ndarray:
    """The keys of contexts of d bytes in which those given end."""
    return ((key >> np.uint64(8)) & np.uint64((1 << 8 * d) - 1)) << np.uint64(8) | (key & np.uint64(255))


def above(key: np.ndarray, zero: np.ndarray, one: np.ndarray, weighted: np.ndarray, d: int) -> tuple[np.ndarray, ...]:
    """key, zeros, ones, weighted, stop and probability of a one, at the contexts of d bytes above those given."""
    key, zero, one, split = _sums(_up(key, d), zero, one, weighted)
    block, p = _kt(zero, one)
    return key, zero, one, *_weigh(block, split), p


def mixed(asked: np.ndarray, bit: np.ndarray, key: np.ndarray, stop: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """q, what the deeper contexts say, mixed with the contexts of one level."""
    if not len(key):
        return np.full(q.shape, 0.5)
    at = np.minimum(np.searchsorted(key, asked), len(key) - 1)
    s, here = stop[at], np.where(bit, p[at], 1 - p[at])
    return np.where(key[at] == asked, s * here + (1 - s) * q, 0.5)


def _build(depth: int):
    """For the grams of some contexts of three bytes: the probabilities of their decisions from there on down.

    A row for each gram, and one with the sums of its contexts of two bytes, for the levels above.
    """

    def run(key, t):
        gram, n = t["gram"].to_numpy().view(np.uint64), t["n"].to_numpy().astype(float)
        q, edges = np.full((len(gram), 8), 0.5), []
        # in runs of about SLICE grams: contexts of three bytes and more are apart
        three = (gram >> np.uint64(8)) & np.uint64(0xFFFFFF)
        order = np.argsort(three, kind="stable")
        ends = np.flatnonzero(np.diff(three[order], append=1 << 24))
        lo = 0
        for k, end in enumerate(ends + 1):
            if k < len(ends) - 1 and ends[k + 1] + 1 - lo <= SLICE:
                continue
            part, lo = order[lo:end], end
            seen = part[n[part] > 0]
            if len(seen):
                x = _Levels(gram[seen], n[seen], 3, depth)
                q[part] = x.ask(gram[part])
                edges.append(x.edge)
        top = None
        if edges:
            node, zero, one, weighted = (np.concatenate(c) for c in zip(*edges, strict=True))
            top = np.stack(_sums(_up(node, 2), zero, one, weighted)).astype(float).tobytes()
        q = q.astype(np.float32)
        rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(q), [None, pa.py_buffer(q.tobytes())]).cast(pa.binary())
        grams = pa.concat_arrays([pa.array(gram.view(np.int64)), pa.nulls(1, pa.int64())])
        tops = pa.concat_arrays([pa.nulls(len(q), pa.binary()), pa.array([top], pa.binary())])
        part = pa.array(np.full(len(q) + 1, key[0].as_py(), np.int32))
        return pa.table({"part": part, "gram": grams, "q": pa.concat_arrays([rows, pa.nulls(1, pa.binary())]), "top": tops})

    return run


def _parted(grams: DataFrame) -> DataFrame:
    """grams with near2 (the two nearest bytes) and part, a group of contexts of about GROUP grams that are weighted together.

    Contexts that share their two nearest bytes are a group, unless they are many: then they are dealt by the third
    byte. One context of three bytes has at most 2**24 grams (at depth 5) whatever the corpus, so no part grows with it.
    """
    near2 = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))
    x = grams.withColumn("near2", near2)
    sizes = stored(x.groupBy("near2").agg(F.count("*").alias("members")), "near-sizes")  # 65,536 rows at most
    parts = max(LEAST_BUCKETS, (sizes.agg(F.sum("members").alias("n")).first()["n"] or 0) // GROUP)
    third = F.when(F.col("members") > SLICE, F.shiftright("gram", 24).bitwiseAND(F.lit(0xFF)))
    x = x.join(F.broadcast(sizes), "near2")
    return x.select("gram", "n", "near2", F.pmod(F.xxhash64("near2", third), F.lit(parts)).cast("int").alias("part"))


def gram_logs(grams: DataFrame, depth: int, buckets: int) -> DataFrame:
    """grams: gram, n (0 for those to be scored only). Returns bucket, gram and the log10 probability of its byte in its context.

    Only sums over one byte of context and a node reach the driver: 256 * 255 at most, whatever the corpus.
    """
    if not 3 <= depth <= 6:
        raise ValueError(f"depth {depth}; contexts have 3 to 6 bytes")
    parted = _parted(grams)
    built = stored(parted.select("part", "gram", "n").groupBy("part").applyInArrow(_build(depth), "part int, gram long, q binary, top binary"), "contexts")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b["top"].to_pylist():
                node, zero, one, weighted = np.frombuffer(x).reshape(4, -1)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (node.astype(np.int64), zero, one, weighted)], names=["node", "zero", "one", "weighted"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            zero, one, below = (b[c].to_numpy(zero_copy_only=False) for c in ("zero", "one", "weighted"))
            block, p = _kt(zero, one)
            weighted, stop = _weigh(block, below)
            yield pa.RecordBatch.from_arrays([b["node"], b["zero"], b["one"], *(pa.array(v) for v in (weighted, stop, p))], names=["node", "zero", "one", "weighted", "stop", "p"])

    sums = [F.sum(c).alias(c) for c in ("zero", "one", "weighted")]
    two = built.where("top is not null").select("top").mapInArrow(split, "node long, zero double, one double, weighted double").groupBy("node").agg(*sums)
    two = stored(two.mapInArrow(weigh, "node long, zero double, one double, weighted double, stop double, p double"), "two-bytes")
    above1 = F.shiftright("node", 8).bitwiseAND(F.lit(0xFF)) * 256 + F.col("node").bitwiseAND(F.lit(0xFF))
    rows = two.groupBy(above1.alias("node")).agg(*sums).orderBy("node").collect()
    key = np.array([r["node"] for r in rows], np.uint64)
    zero, one, weighted = (np.array([r[c] for r in rows], float) for c in ("zero", "one", "weighted"))
    block, p = _kt(zero, one)
    weighted, stop = _weigh(block, weighted)
    high = [(1, key, stop, p)]
    if len(key):
        key, _, _, _, stop, p = above(key, zero, one, weighted, 0)
        high.append((0, key, stop, p))

    def finish(rows: pa.Table, nodes: pa.Table) -> pa.Table:
        gram = rows["gram"].to_numpy().view(np.uint64)
        q = np.frombuffer(b"".join(rows["q"].to_pylist()), np.float32).reshape(-1, 8).astype(float)
        bit = _BIT[(gram & np.uint64(255)).astype(np.int64)] == 1
        order = np.argsort(nodes["node"].to_numpy())
        levels = [(2, *(nodes[c].to_numpy()[order] for c in ("node", "stop", "p"))), *high]
        for d, node, stop, p in levels:
            q = mixed(_key(gram, d), bit, node.astype(np.uint64), stop, p, q)
        return pa.table({"bucket": pa.array(_bucket(gram, buckets), pa.int32()), "gram": rows["gram"], "log": np.log10(np.maximum(q, 1e-30)).sum(axis=1)})

    near2 = F.shiftright("node", 8)
    where = parted.select("near2", "part").distinct()
    nodes = two.select(near2.alias("near2"), "node", "stop", "p").join(where, "near2").select("part", "node", "stop", "p")
    grams_of = built.where("gram is not null").select("part", "gram", "q")
    return grams_of.groupBy("part").cogroup(nodes.groupBy("part")).applyInArrow(finish, "bucket int, gram long, log double")


# ---------------------------------------------------------------- scoring


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves 2 on division by 7; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _answered(asks: pa.Table, logs: pa.Table) -> pa.Table:
    """The rows of asks, all of one bucket, with the logs of their grams."""
    known, log = logs["gram"].to_numpy().view(np.uint64), logs["log"].to_numpy().astype(np.float32)
    order = np.argsort(known)
    known, log = known[order], log[order]
    out = [zstandard.compress(log[np.searchsorted(known, _grams_of(g.as_py()))].tobytes(), 1) for g in asks["asked"]]
    return pa.table({"chunk": asks["chunk"], "asked": asks["asked"], "logs": pa.array(out, pa.binary()), "counts": pa.nulls(len(out), pa.binary())})


def _tokens(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of lower-cased texts, and how many each text has."""
    words = pc.ascii_split_whitespace(texts)
    flat, owner = words.flatten(), np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(flat), 0)
    flat, owner = flat.filter(full), owner[full.to_numpy(zero_copy_only=False)]
    return flat.dictionary_encode(), np.bincount(owner, minlength=len(texts))


def _looked_up(depth: int, n_all: int, v_all: int, ends: int):
    """For the texts of a chunk and the answers to its grams and words: a row per text with its scores."""

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        known, log, seen = [], [], {}
        for a, x, c in zip(answers["asked"], answers["logs"], answers["counts"], strict=True):
            if c.is_valid:
                seen.update(zip(_words_of(a.as_py()), _unpacked(c.as_py()).tolist(), strict=True))
            else:
                known.append(_grams_of(a.as_py()))
                log.append(np.frombuffer(zstandard.decompress(x.as_py()), np.float32))
        known, log = pa.array(np.concatenate(known).view(np.int64)), np.concatenate(log).astype(float)
        out = []
        for i in range(rows.num_rows):
            size, raw = rows["size"][i].values.to_numpy(), zstandard.decompress(rows["text"][i].as_py())
            upto = np.concatenate(([0], np.cumsum(size)))
            texts = [raw[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)]
            at = pc.index_in(pa.array(text_grams(texts, depth).view(np.int64)), value_set=known)
            assert not at.null_count
            score = np.add.reduceat(log[at.to_numpy()], upto[:-1] + np.arange(len(texts)))
            words, n = _tokens(pa.array(texts, pa.binary()).cast(pa.string()))
            count = np.array([seen[w.encode()] for w in words.dictionary.to_pylist()], np.int64)[words.indices.to_numpy(zero_copy_only=False)]
            bounds = np.concatenate(([0], np.cumsum(n)))
            upto_known, upto_log = (np.concatenate(([0], np.cumsum(v))) for v in (count > 0, np.log10(count + 1)))
            n_known = upto_known[bounds[1:]] - upto_known[bounds[:-1]] + (ends > 0)
            base = upto_log[bounds[1:]] - upto_log[bounds[:-1]] + math.log10(ends + 1) - (n + 1) * math.log10(n_all + v_all + 1)
            out.append(pa.table({"doc_id": rows["doc_id"][i].values, "held_out": rows["held_out"][i].values, "n_tokens": n + 1, "n_known": n_known, "base_score": base, "score": score, "n_bytes": size + 1}))
        return pa.concat_tables(out)

    return run


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    score is the log10 probability that the weighted context trees give the text's bytes, A-Z lower-cased, and its
    end; bits_per_byte is its code length over all bytes and the end. base_score sums log10((c + 1) / (N + V + 1)) over
    the tokens: words between white space, then one end; c, N and V as counted in the training rows. Training rows are
    those that are not held out. Null texts count as empty: one token, the end. Repeated rows are scored one by one.
    All contexts and words of the training rows count. An empty table gives an empty result; without training rows
    every bit has probability one half and every token counts as unknown. Columns other than doc_id and text are
    ignored.

    Texts are read once, and kept compressed by chunks of about LOOKUP bytes. A chunk asks for each of its different
    grams and words once; asks are dealt to buckets, where counts are summed and answered. Chunks and buckets are
    bounded, and their number grows with the corpus.
    """
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = max(LEAST_BUCKETS, (rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0) // BUCKET)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, filled, grams, words = TaskContext.get().partitionId() << 32, 0, None, Counter()

        def asks():
            rows = [*_dealt(chunk, grams, buckets), *_dealt_words(chunk, words, buckets)]
            for i in range(0, len(rows), 64):
                cols = list(zip(*rows[i : i + 64], strict=True))
                have = dict(zip(("chunk", "bucket", "is_words", "asked", "times"), cols, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(have[f.name], f.type) if f.name in have else pa.nulls(len(cols[0]), f.type) for f in fields], schema=pa.schema(fields))

        for whole in batches:
            for at, texts in _batches(whole["text"]):
                b = whole.slice(at, len(texts))
                size = [len(t) for t in texts]
                if filled and filled + sum(size) > LOOKUP:
                    yield from asks()
                    chunk, filled, grams, words = chunk + 1, 0, None, Counter()
                filled += sum(size) + len(texts)
                out = b["held_out"].to_numpy(zero_copy_only=False)
                for held in (False, True):
                    some = [t for t, o in zip(texts, out, strict=True) if o == held]
                    if some:
                        grams = _merge(grams, text_grams(some, depth), int(not held))
                        coded, _ = _tokens(pa.array(some, pa.binary()).cast(pa.string()))
                        times = np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary)) * (not held)
                        for w, k in zip(coded.dictionary.to_pylist(), times.tolist(), strict=True):
                            words[w.encode()] += k
                one = {"chunk": [chunk], "doc_id": [b["doc_id"].to_pylist()], "held_out": [out.tolist()], "size": [size], "text": [zstandard.compress(b"".join(texts), 3)]}
                yield pa.RecordBatch.from_arrays([pa.array(one.get(f.name, [None]), f.type) for f in fields], schema=pa.schema(fields))
        if grams is not None:
            yield from asks()

    kind = dict(rows.dtypes)["doc_id"]
    # rows of texts, and rows of grams or words (with a bucket) that the texts of a chunk ask for
    shape = f"chunk long, doc_id array<{kind}>, held_out array<boolean>, size array<long>, text binary, bucket int, is_words boolean, asked binary, times binary"
    fields = list(to_arrow_schema(docs.sparkSession.createDataFrame([], shape).schema))
    both = stored(rows.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, shape), "texts")
    asks, texts = both.where("bucket is not null"), both.where("bucket is null")
    words = asks.where("is_words").select("bucket", "chunk", "asked", "times").groupBy("bucket").applyInArrow(_counted, "chunk long, asked binary, counts binary, different long, tokens long")
    words = stored(words, "words")
    of = words.agg(F.sum("tokens").alias("n"), F.sum("different").alias("v")).first()
    ends = texts.agg(F.sum(F.size(F.filter("held_out", lambda x: ~x))).alias("n")).first()["n"] or 0
    n_all, v_all = (of["n"] or 0) + ends, (of["v"] or 0) + (ends > 0)
    grams = stored(asks.where("not is_words").select("bucket", "asked", "times").groupBy("bucket").applyInArrow(_summed, "gram long, n long"), "grams")
    logs = gram_logs(grams, depth, buckets)
    answers = asks.where("not is_words").select("bucket", "chunk", "asked").groupBy("bucket").cogroup(logs.groupBy("bucket")).applyInArrow(_answered, "chunk long, asked binary, logs binary, counts binary")
    answers = answers.unionByName(words.select("chunk", "asked", F.lit(None).cast("binary").alias("logs"), "counts"))
    told = texts.select("chunk", "doc_id", "held_out", "size", "text").groupBy("chunk").cogroup(answers.groupBy("chunk"))
    out = told.applyInArrow(_looked_up(depth, n_all, v_all, ends), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    bits = -F.col("score") * F.lit(math.log2(10)) / F.col("n_bytes")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score", bits.alias("bits_per_byte"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
