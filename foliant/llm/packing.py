"""Packing token sequences by shortest-pack-first over the histogram of lengths.

Documents are tokenised where they are read and cut into pieces of at most `size` tokens. Only the histogram of piece
lengths, at most `size` numbers, goes to the driver: lengths are placed longest first, each into the open packing
pattern with most room, and patterns carry counts, so the work does not depend on the number of documents. Pieces are
then ranked within their length and looked up in the plan by rank.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table, text_slices

SIZE, END_ID = 2048, 1
#: Words whose ids a worker remembers: the memory it may take, not what it may encode.
REMEMBERED = 1_000_000
#: Buckets in which pieces of one length are ranked apart, per million pieces of that length.
BUCKETS = 64

_TOKENIZERS: dict = {}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Ids:
    """Lower-cased chunks between ASCII white space, and their ids.

    The tokenizer lower-cases, drops white space and never merges across it, so chunks do not interact. Full stops and
    commas after a letter or digit are words of their own to it, and so are encoded apart, which leaves far fewer
    different words. Words of letters alone are encoded many at once: each ends with the one token marked as an end.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.is_end = np.zeros(max(vocab.values()) + 1, bool)
        self.is_end[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}

    def _each(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        stop = (4 * (np.flatnonzero(self.is_end[ids]) + 1)).tolist()
        if len(stop) != len(words):
            return self._each(words)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *stop[:-1]], stop, strict=True)]

    def of(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk, as bytes."""
        known = self.known
        got = list(map(known.get, chunks))
        cut = {c: x if (x := c.rstrip(".,")) and x[-1].isascii() and x[-1].isalnum() else c for c, i in zip(chunks, got, strict=True) if i is None}
        words = {w for c, x in cut.items() for w in (x, c[len(x) :]) if w not in known}
        if len(known) + len(words) > REMEMBERED:
            self.known = known = {"": b""}
            words = {w for c, x in cut.items() for w in (x, c[len(x) :]) if w}
        plain = [x for x in words if x.isalpha()]
        for some, how in ((plain, self._letters), ([x for x in words if not x.isalpha()], self._each)):
            for at in range(0, len(some), 5_000):
                part = some[at : at + 5_000]
                known.update(zip(part, how(part), strict=True))
        return [known[cut[c]] + known[c[len(cut[c]) :]] if i is None else i for c, i in zip(chunks, got, strict=True)]


def encode(texts: pa.Array, path: str, end_id: int = END_ID) -> tuple[bytes, list[int]]:
    """The ids of all texts, each followed by end_id, as little-endian 32-bit numbers; and where each text's begin, and the end.

    Every different chunk of the batch is looked up once; the rest is array work.
    """
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = _Ids(path)
    own = _TOKENIZERS[path]
    texts = pc.fill_null(texts, "")
    special = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False))  # may hold special tokens, matched as written
    mask = np.zeros(len(texts), bool)
    mask[special] = True
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(pa.array(mask), "", texts) if len(special) else texts))
    coded = words.flatten().dictionary_encode()
    ids = own.of(coded.dictionary.to_pylist())
    # after its words every text has the end id; a text encoded apart has its ids there too
    apart = [np.array([*own.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, end_id], "<u4").tobytes() for i in special]
    last = np.full(len(texts), len(ids), np.int32)
    last[special] = len(ids) + 1 + np.arange(len(special))
    word_end = np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))
    code = np.insert(coded.indices.to_numpy(zero_copy_only=False), word_end, last)
    ids += [np.array([end_id], "<u4").tobytes(), *apart]
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    pool = np.frombuffer(b"".join(ids), "<u4")
    length = size[code]
    upto = np.cumsum(length)
    bounds = np.concatenate(([0], upto[word_end + np.arange(len(texts))]))
    kind = np.int32 if bounds[-1] < 2**31 and len(pool) < 2**31 else np.int64
    source = np.repeat(((np.cumsum(size) - size)[code] - (upto - length)).astype(kind), length)
    source += np.arange(len(source), dtype=kind)
    return pool[source].tobytes(), bounds.tolist()


_PIECES = "doc_id long, doc_row long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, doc_row (tells rows with one doc_id apart), start, length, ids_crc32, doc_tokens, and ids if asked for."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at, rows in text_slices(whole["text"], 2_500):
                b = whole.slice(at, rows)
                out = []
                ids, bounds = encode(b["text"], path, end_id)
                for doc, row, lo, hi in zip(b["doc_id"].to_pylist(), b["doc_row"].to_pylist(), bounds[:-1], bounds[1:], strict=True):
                    for s in range(lo, hi, size):
                        e = min(s + size, hi)
                        x = ids[4 * s : 4 * e]
                        out.append((doc, row, s - lo, e - s, zlib.crc32(x), hi - lo) + ((x,) if with_ids else ()))
                cols = list(zip(*out, strict=True)) if out else [[]] * (6 + with_ids)
                names = ["doc_id", "doc_row", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:6]] + [pa.array(c, pa.binary()) for c in cols[6:]], names=names)

    rows = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("doc_row"), F.col("text").cast("string"))
    return rows.mapInArrow(run, _PIECES + (", ids binary" if with_ids else ""))


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns as (count, [(length, times), ...]), the lengths longest first.

    Lengths are placed longest first, each into the open pattern with most room. A pattern whose packs outnumber the
    pieces left splits in two; as many pieces of one length as fit go into a pack at once.
    """
    open_: list[tuple[int, int, int, list[tuple[int, int]]]] = []  # (-room, order, count, content)
    done, order = [], 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if open_ and -open_[0][0] >= length:
                room, _, count, content = heapq.heappop(open_)
                room = -room
            else:
                room, count, content = size, -1, []
            if count < 0:
                times = min(room // length, left)
                used = left // times
            else:
                times = min(room // length, max(1, left // count))
                used = min(count, left // times)
                if used < count:
                    order += 1
                    heapq.heappush(open_, (-room, order, count - used, content))
            left -= used * times
            content = [*content, (length, times)]
            room -= length * times
            if room:
                order += 1
                heapq.heappush(open_, (-room, order, used, content))
            else:
                done.append((used, content))
    return done + [(count, content) for _, _, count, content in open_]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, tuple[list[int], list[int], list[int], list[int], list[int]]]:
    """By length, sorted by rank: first rank, first sequence, packs, times, offset of the first piece in its sequence."""
    out: dict[int, tuple] = {}
    ranks: dict[int, int] = {}
    first = 0
    for count, content in patterns:
        at = 0
        for length, times in content:
            x = out.setdefault(length, ([], [], [], [], []))
            for col, v in zip(x, (ranks.get(length, 0), first, count, times, at), strict=True):
                col.append(v)
            ranks[length] = ranks.get(length, 0) + count * times
            at += length * times
        first += count
    return out


def ranked(cut: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """cut with `rank`, from 0 within each length.

    Pieces of one length are ranked in buckets of a hash, whose offsets come from counts, so that a length that a
    third of all pieces have is ranked by many tasks.
    """
    n = max(1, max(histogram.values(), default=1) * BUCKETS // 1_000_000, min(BUCKETS, max(histogram.values(), default=1) // 200))
    x = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "doc_row", "start"), F.lit(n)))
    sizes = x.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "doc_row", "start")) - 1
    return x.withColumn("within", within).join(sizes, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("within")).drop("before", "within", "bucket")


def placed(rows: DataFrame, where: dict, spark: SparkSession) -> DataFrame:
    """rows (with length and rank) with sequence_id and offset."""
    lookup = spark.sparkContext.broadcast({k: tuple(np.array(c, np.int64) for c in v) for k, v in where.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b["length"].to_numpy(zero_copy_only=False), b["rank"].to_numpy(zero_copy_only=False)
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            bounds = np.flatnonzero(np.diff(length[order])) + 1
            for idx in np.split(order, bounds) if len(order) else []:
                size = int(length[idx[0]])
                ranks, first, packs, times, at = lookup.value[size]
                j = np.searchsorted(ranks, rank[idx], side="right") - 1
                r = rank[idx] - ranks[j]
                seq[idx] = first[j] + r // times[j]
                off[idx] = at[j] + (r % times[j]) * size
            keep = [c for c in b.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([b[c] for c in keep] + [pa.array(seq), pa.array(off)], names=[*keep, "sequence_id", "offset"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "rank"]
    return rows.mapInArrow(run, ", ".join([*kinds, "sequence_id long", "offset long"]))


def pack(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece with its place: doc_id, doc_row, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Null and empty texts are documents of the end id alone. Rows that repeat a doc_id are packed one by one and told
    apart by doc_row. An empty table gives an empty result. Columns other than doc_id and text are ignored. Pieces are
    cut from whole texts, however long; sequences hold at most `size` tokens and have no gaps.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, size, end_id, path, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    return placed(ranked(cut, histogram), slots(plan(histogram, size)), spark)


def sequences(packed: DataFrame) -> DataFrame:
    """Sequences with their ids, little-endian 32-bit, from pack(..., with_ids=True); each is at most `size` tokens."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
