"""Removes every byte covered by a string of WIDTH bytes that stands anywhere else in the corpus.

Windows of WIDTH bytes are dealt out by content: each takes the trigger inside it (suffix_array.triggers) whose next KEY
bytes hash lowest, the first of equals, so equal windows take the same key wherever they stand. The windows of a text
that share a trigger are a run, one row. A run that its own text repeats is told at once, and goes on once for the sake
of other texts; runs whose key occurs once are done. Of the others equal stretches are counted once, with their number,
and only one copy of each is read again. Runs with one key meet in a task, which sorts their suffixes by linear grouping
(suffix_array.repeated_windows) and tells which windows stand in another stretch or in one that is counted more than
once. No other key can hold an equal window.

Where many different stretches share a key (a frequent passage in a thousand contexts), their runs are cut by the
distance from window to trigger into runs of 16 windows, whose key is all bytes that those windows share; where even
that is frequent, into single windows, whose key is the window itself, so that one stretch is left for a key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, text_of
from .suffix_array import loads, mixed, repeated_windows, triggers

WIDTH = 400
#: Bytes behind a trigger that make its key. A window of WIDTH bytes has triggers on its first WIDTH - KEY + 1 places.
KEY = 64
#: Windows in a run, by how often the runs have been cut.
CUTS = (0, 16, 1)
#: Bytes of different stretches that may share a key before their runs are cut, and bytes that are sorted at a time.
STRETCH_BYTES, SORT_BYTES = 1_000_000, 500_000
#: Bytes of texts that are scanned at a time; a longer text is scanned by itself.
SCAN_BYTES = 2_000_000

SPANS = "array<struct<at int, n int>>"
#: A run: its place, windows, distance from its first window to the trigger, key, digest of all its bytes, and how often it is in its text. A row without a key has in `own` what repeats within its text.
RUN = f"doc_id long, text_key long, first int, windows int, near int, times int, key long, stretch long, own {SPANS}"


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _hashes(text: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes (a multiple of eight) from each position on."""
    h = np.full(len(at), np.uint64(size))
    for j in range(0, size, 8):
        h = mixed(h ^ loads(text, at + j))
    return h


def runs_of(texts: list[bytes], width: int = WIDTH, key: int = KEY) -> tuple[np.ndarray, ...]:
    """Runs of windows: text, first window, windows, distance from the first window to the trigger, key; windows without a trigger are runs of one, with themselves as key."""
    reach = width - key
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    total = int(ends[-1])
    flat = np.frombuffer(b"".join(texts) + bytes(width + 8), np.uint8)
    cut = triggers(flat[: total + 7])
    own = np.searchsorted(ends, cut, "right")
    fits = cut + key <= np.append(ends, total)[own]
    cut, own = cut[fits], own[fits]
    h = _hashes(flat, cut, key)
    n = len(cut)
    lower, upper = cut - reach, cut.copy()  # windows for which the trigger is the lowest
    for d in range(1, n):
        near = cut[d:] - cut[:-d] <= reach
        if not near.any():
            break
        blocked = near & (h[:-d] <= h[d:])  # of equals the first
        lower[d:] = np.maximum(lower[d:], np.where(blocked, cut[:-d] + 1, lower[d:]))
        blocked = near & (h[d:] < h[:-d])
        upper[:-d] = np.minimum(upper[:-d], np.where(blocked, cut[d:] - reach - 1, upper[:-d]))
    lower, upper = np.maximum(lower, begins[own]), np.minimum(upper, ends[own] - width)
    real = lower <= upper
    cut, own, h, lower, upper = cut[real], own[real], h[real], lower[real], upper[real]
    steps = np.zeros(total + 1, np.int32)
    steps += np.bincount(lower, minlength=total + 1).astype(np.int32) - np.bincount(upper + 1, minlength=total + 1).astype(np.int32)
    for b, e in zip(begins.tolist(), ends.tolist(), strict=True):  # places at which no window begins count as covered
        at = max(b, e - width + 1)
        if at < e:
            steps[at] += 1
            steps[e] -= 1
    bare = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
    at = np.concatenate([lower, bare])
    owner = np.concatenate([own, np.searchsorted(ends, bare, "right")]).astype(np.int64)
    return owner, at - begins[owner], np.concatenate([upper - lower + 1, np.ones(len(bare), np.int64)]), np.concatenate([cut - lower, np.zeros(len(bare), np.int64)]), np.concatenate([h, _hashes(flat, bare, width)]).view(np.int64)


def _slices(batch: pa.RecordBatch) -> Iterator[list[int]]:
    """Rows of a batch in turn, so many that their texts stay within SCAN_BYTES."""
    sizes = pc.binary_length(batch["text"]).to_pylist()
    rows, held = [], 0
    for i, n in enumerate(sizes):
        if rows and held + n > SCAN_BYTES:
            yield rows
            rows, held = [], 0
        rows.append(i)
        held += n
    if rows:
        yield rows


def _merged(at: np.ndarray, n: np.ndarray) -> list[dict]:
    """Windows [at, at + n) as few such spans, in order."""
    out: list[list[int]] = []
    for a, k in sorted(zip(at.tolist(), n.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], a + k)
        else:
            out.append([a, a + k])
    return [{"at": a, "n": z - a} for a, z in out]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of texts. What repeats within a text is told at once; one of its runs goes on for the sake of other texts."""
    for b in batches:
        for rows in _slices(b):
            texts = [b["text"][i].as_py() for i in rows]
            owner, first, windows, near, keys = runs_of(texts)
            stretch = np.array([_digest(texts[o][f : f + n + WIDTH - 1]) for o, f, n in zip(owner.tolist(), first.tolist(), windows.tolist(), strict=True)], np.int64)
            by = np.lexsort((first, stretch, keys, owner))
            new = np.ones(len(by), bool)
            new[1:] = (np.diff(owner[by]) != 0) | (np.diff(keys[by]) != 0) | (np.diff(stretch[by]) != 0)
            one = by[new]
            times = np.diff(np.append(np.flatnonzero(new), len(by)))
            again = by[np.repeat(times > 1, times)]
            own = [(o, _merged(first[again[owner[again] == o]], windows[again[owner[again] == o]])) for o in np.unique(owner[again]).tolist()]
            place = pa.array(np.asarray(rows)[owner[one]])
            yield _run_batch(b["doc_id"].take(place), b["text_key"].take(place), first[one], windows[one], near[one], times, keys[one], stretch[one])
            if own:
                place = pa.array([rows[o] for o, _ in own])
                none = [None] * len(own)
                yield _run_batch(b["doc_id"].take(place), b["text_key"].take(place), none, none, none, none, none, none, [x for _, x in own])


def _run_batch(doc_id, text_key, first, windows, near, times, keys, stretch, own=None) -> pa.RecordBatch:
    i32, i64 = pa.int32(), pa.int64()
    arrays = [doc_id, text_key, *(pa.array(x, i32) for x in (first, windows, near, times)), pa.array(keys, i64), pa.array(stretch, i64)]
    arrays.append(pa.array(own or [None] * len(doc_id), pa.list_(pa.struct([("at", i32), ("n", i32)]))))
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", "first", "windows", "near", "times", "key", "stretch", "own"])


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and text as bytes. Rows that repeat both are texts of their own."""
    t = text_of().cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(t).alias("text_key"), t.alias("text"))


def _with_text(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """text and `want` of the texts that wanted (doc_id, text_key, want) names; a row that is repeated has both again."""
    per = wanted.groupBy(F.col("doc_id").alias("w_id"), F.col("text_key").alias("w_key")).agg(F.collect_list("want").alias("want"))
    return keyed.join(per, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_key") == F.col("w_key")))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted stretches: key, stretch, times, data."""
    for b in batches:
        for i in range(b.num_rows):
            text, want = b["text"][i].as_py(), b["want"][i].as_py()
            for lo in range(0, len(want), 4_096):
                part = want[lo : lo + 4_096]
                yield pa.RecordBatch.from_arrays([pa.array([w[k] for w in part], pa.int64()) for k in ("key", "stretch", "times")] + [pa.array([text[w["first"] : w["first"] + w["windows"] + WIDTH - 1] for w in part], pa.binary())], names=["key", "stretch", "times", "data"])


def _cut(windows: int):
    """Runs of wanted runs cut to `windows` windows by their distance to the trigger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                text, want, rows = b["text"][i].as_py(), b["want"][i].as_py(), []
                for w in want:
                    far, stop = w["near"], w["near"] - w["windows"]  # distances fall from far to stop + 1
                    while far > stop:
                        low = max(far // windows * windows, stop + 1)
                        first = w["first"] + w["near"] - far
                        size = far - low + 1
                        trigger = w["first"] + w["near"]
                        top = far // windows * windows + windows - 1  # all windows of the class share these bytes
                        core = text[trigger - far // windows * windows : trigger - top + WIDTH]
                        rows.append((first, size, far, w["times"], _digest(b"%d %d " % (w["key"], far // windows) + core), _digest(text[first : first + size + WIDTH - 1])))
                        far = low - 1
                for lo in range(0, len(rows), 50_000):
                    c = list(zip(*rows[lo : lo + 50_000], strict=True))
                    yield _run_batch(pa.array([b["doc_id"][i].as_py()] * len(c[0]), pa.int64()), pa.array([b["text_key"][i].as_py()] * len(c[0]), pa.int64()), *c)

    return run


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by key; whole keys are gathered to SORT_BYTES. Gives key, stretch and the windows that occur elsewhere, as pairs of first and number."""
    held, size = [], 0

    def told() -> pa.RecordBatch:
        runs = []
        for (_, _, times, data), hit in zip(held, repeated_windows([x[3] for x in held], WIDTH), strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8) if times == 1 else np.ones(len(hit), np.int8), [0]])))
            runs.append([{"at": int(a), "n": int(z - a)} for a, z in zip(edge[::2], edge[1::2], strict=True)])
        kind = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in held], pa.int64()), pa.array([x[1] for x in held], pa.int64()), pa.array(runs, kind)], names=["key", "stretch", "hits"])

    for b in batches:
        for row in zip(*(b[c].to_pylist() for c in ("key", "stretch", "times", "data")), strict=True):
            if held and row[:2] == held[-1][:2]:  # a text that is repeated gives its stretches again
                continue
            if size >= SORT_BYTES and row[0] != held[-1][0]:
                yield told()
                held, size = [], 0
            held.append(row)
            size += len(row[3])
    if held:
        yield told()


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, and `spans`: the repeated windows of each text that has any, as (at, n) with n windows from byte `at` on."""
    keyed = _keyed(docs)
    runs = stored(keyed.where(F.octet_length("text") >= WIDTH).mapInArrow(_scan, RUN), "runs")
    found = runs.where("own is not null").select("doc_id", "text_key", F.explode("own").alias("h")).select("doc_id", "text_key", "h.*")
    runs = runs.where("key is not null").drop("own")
    for level, _ in enumerate(CUTS):
        often = stored(runs.groupBy("key").agg(F.sum("times").alias("n")).where("n > 1").select("key"), "repeated-keys")
        alive = stored(runs.join(often, "key"), "repeated-runs")
        one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "first", "windows")).alias("one")
        part = stored(alive.groupBy("key", "stretch").agg(F.sum("times").alias("times"), one), "stretches")
        rest = part
        if level + 1 < len(CUTS):
            big = part.groupBy("key").agg(F.sum(F.col("one.windows") + WIDTH - 1).alias("bytes"), F.count("*").alias("n")).where(f"bytes > {STRETCH_BYTES} and n > 1").select("key")
            big = stored(big, "frequent-keys")
            rest = part.join(big, "key", "left_anti")
        want = rest.select("one.doc_id", "one.text_key", F.struct("one.first", "one.windows", "key", "stretch", "times").alias("want"))
        data = _with_text(keyed, want).select("text", "want").mapInArrow(_stretches, "key long, stretch long, times long, data binary")
        told = data.repartition("key").sortWithinPartitions("key", "stretch").mapInArrow(_sort, f"key long, stretch long, hits {SPANS}")
        told = stored(told.where("size(hits) > 0"), "hits")
        # runs that are in their text more than once are told already
        hit = alive.where("times = 1").join(told, ["key", "stretch"]).select("doc_id", "text_key", "first", F.explode("hits").alias("h"))
        found = found.unionByName(hit.select("doc_id", "text_key", (F.col("first") + F.col("h.at")).alias("at"), F.col("h.n").alias("n")))
        if level + 1 == len(CUTS) or big.isEmpty():
            break
        again = alive.join(big, "key").select("doc_id", "text_key", F.struct("first", "windows", "near", "times", "key").alias("want")).distinct()
        runs = stored(_with_text(keyed, again).select("doc_id", "text_key", "text", "want").mapInArrow(_cut(CUTS[level + 1]), RUN), "cut-runs").drop("own")
    return found.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("at", "n")).alias("spans"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for rows in _slices(b):
            out = []
            for i in rows:
                text, runs = b["text"][i].as_py(), []
                for at, end in sorted((x["at"], x["at"] + x["n"] + WIDTH - 1) for x in b["spans"][i].as_py() or ()):
                    if runs and at <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([at, end])
                edges = [0, *(x for r in runs for x in r), len(text)]
                kept = b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
                out.append((b["doc_id"][i].as_py(), len(text), len(text) - len(kept), len(runs), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes that are left).

    A byte goes when any string of WIDTH bytes over it also starts anywhere else, in another row or in its own; strings are
    those of the input, and overlaps count. So all copies of a passage go, none is left as a first. Rows that repeat a
    document are documents of their own, and lose all that is in strings of WIDTH bytes. Null texts count as empty; texts
    shorter than WIDTH bytes stay whole. Null ids are values like others. An empty table gives an empty result; columns other
    than doc_id and text are ignored. What is left need not be UTF-8.
    """
    keyed, found = _keyed(docs), spans(docs)
    found = stored(found.withColumnsRenamed({"doc_id": "s_id", "text_key": "s_key"}), "spans")
    x = keyed.join(found, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("text_key") == F.col("s_key")), "left")
    return x.select("doc_id", "text", "spans").mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = without_repeats(table(spark, sf_dir, "documents"))
    return x.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: Every window of WIDTH bytes by its digest, over texts in hexadecimal digits; for tables small enough for a row for each byte.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
c AS (SELECT rid, c, substr(x, c * 2000 + 1, 2798) AS y FROM (SELECT rid, x, unnest(range(0, length(x) // 2000 + 1)) AS c FROM d)),
w AS (SELECT rid, c * 1000 + s AS s, md5(substr(y, 2 * s + 1, 800)) AS h FROM (SELECT rid, c, y, unnest(range(0, length(y) // 2 - 399)) AS s FROM c WHERE length(y) >= 800)),
o AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
r AS (SELECT rid, s, sum(new) OVER (PARTITION BY rid ORDER BY s) AS run FROM (SELECT rid, s, (s > coalesce(lag(s) OVER (PARTITION BY rid ORDER BY s) + 400, -1))::int AS new FROM w SEMI JOIN o USING (h))),
u AS (SELECT rid, run, min(s) AS a, max(s) + 400 AS b FROM r GROUP BY ALL),
k AS (SELECT rid, sum(b - a)::bigint AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM u GROUP BY rid)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(array_to_string(list_transform(range(0, n_spans + 1), lambda i: x[2 * (CASE WHEN i = 0 THEN 0 ELSE b[i] END) + 1:2 * (CASE WHEN i = n_spans THEN length(x) // 2 ELSE a[i + 1] END)]), ''), x))) AS kept_sha256
FROM d LEFT JOIN k USING (rid)
"""
