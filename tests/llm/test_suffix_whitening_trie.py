import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from foliant.llm import prefix_trie as pt
from foliant.llm import suffix_array as sa
from foliant.llm import suffix_dedup as sd
from foliant.llm import whitening as wh

# ------------------------------------------------------------------ suffix arrays


def test_suffix_array_against_sorting():
    rng = random.Random(5)
    cases = [[rng.randint(1, rng.choice([1, 2, 5, 300])) for _ in range(rng.randrange(60))] for _ in range(1500)]
    cases += [[1] * 300, [1, 2] * 150, [2, 1] * 150, [1, 1, 2] * 90, [3, 2, 3, 2, 1] * 50]
    for s in (c + [0] for c in cases):
        assert sa.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_repeated_windows_against_counting():
    rng = random.Random(6)
    for _ in range(150):
        width, letters = rng.choice([9, 40, 100]), rng.choice([b"a", b"ab", b"abcdefgh", bytes(range(256))])
        some = lambda n: bytes(rng.choice(letters) for _ in range(rng.randrange(n)))
        pool = [some(200) for _ in range(4)]
        strings = [b"".join(rng.choice(pool)[rng.randrange(30) :] if rng.random() < 0.7 else some(60) for _ in range(rng.randrange(4))) for _ in range(rng.randrange(1, 8))]
        n = Counter(s[i : i + width] for s in strings for i in range(len(s) - width + 1))
        assert [x.tolist() for x in sa.repeated_windows(strings, width)] == [[n[s[i : i + width]] > 1 for i in range(len(s) - width + 1)] for s in strings]


def removed(texts, width=400):
    n = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        runs = []
        for i in range(len(t) - width + 1):
            if n[t[i : i + width]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + width
                else:
                    runs.append([i, i + width])
        edges = [0, *(x for r in runs for x in r), len(t)]
        kept = b"".join(t[a:z] for a, z in zip(edges[::2], edges[1::2]))
        out.append((len(t), len(t) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
    return out


def texts_for_dedup():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvyäß") for _ in range(rng.randrange(1, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passage, frequent = prose(120), prose(70)
    rows = [prose(300), prose(200) + passage + prose(50), passage + prose(10), prose(5), "", None, "a" * 3000, "ab" * 900 + prose(40), "b" + "ab" * 700, passage[:399], passage[1:]]
    rows += [frequent[: rng.randrange(300, 420)] + prose(60) for _ in range(40)] + [prose(30) + frequent + prose(30) for _ in range(40)]
    whole = prose(150)
    rows += [whole] * 30 + [whole[: rng.randrange(900)] + "X" + whole[rng.randrange(100) :] for _ in range(10)] + [passage + passage]
    return rows


@pytest.mark.parametrize("stretch_bytes", [sd.STRETCH_BYTES, 4_000])
def test_repeats_against_brute_force(spark, monkeypatch, stretch_bytes):
    monkeypatch.setattr(sd, "STRETCH_BYTES", stretch_bytes)  # the small bound cuts frequent runs, down to single windows
    rows = [(None if i == 3 else i // 2, t, "x", 1) for i, t in enumerate(texts_for_dedup())]  # repeated and null ids
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, key int")
    out = sd.without_repeats(df).selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256)").collect()
    expected = [(r[0], *x) for r, x in zip(rows, removed([(r[1] or "").encode() for r in rows]))]
    assert Counter(map(tuple, out)) == Counter(expected)


def test_repeats_of_empty_and_long(spark):
    schema = "doc_id long, text string"
    assert sd.without_repeats(spark.createDataFrame([], schema)).collect() == []
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefg ") for _ in range(2_500_000))
    out = {r.doc_id: r for r in sd.without_repeats(spark.createDataFrame([(1, long), (2, long[1_000_000:1_000_500])], schema)).collect()}
    assert (out[1].n_removed, out[1].n_spans, out[2].n_removed) == (500, 1, 500)
    assert bytes(out[1].kept).decode() == long[:1_000_000] + long[1_000_500:]


# ------------------------------------------------------------------ whitening


def spectrum(x):
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    v = np.cov(u.T, bias=True).reshape(x.shape[1], -1)
    values, vectors = np.linalg.eigh(v)
    return n, s, values[::-1], vectors[:, ::-1], np.trace(v)


@pytest.mark.parametrize("size", [3, 12, 80])
def test_whitening_against_eigh(spark, size):
    rng = np.random.default_rng(size)
    e = (rng.standard_normal((300, size)) * np.linspace(2, 0.5, size)).astype(np.float32)
    e[10] = e[20]
    rows = [(i, v.tolist(), 0.0) for i, v in enumerate(e)] + [(900, None, 0.0), (901, [1.0, None], 0.0), (902, [float("nan")] * size, 0.0), (903, [float("-inf")] * size, 0.0), (None, e[5].tolist(), 0.0)]
    got = wh.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>, x double")).collect()
    x = np.floor(e.astype(np.float64) * 256).astype(np.int64)
    n, s, values, vectors, trace = spectrum(x)
    k = min(4, size)
    by = {(r.vec_id, r.component): r for r in got}
    assert len(got) == 301 * k and all(r.n == n for r in got)
    exact = ((n * x - s) ** 2).sum(axis=1)
    for c in range(k):
        mine = np.array([by[i, c + 1].whitened for i in range(300)])
        true = (x - s / n) @ vectors[:, c] / np.sqrt(values[c])
        assert min(np.abs(mine - true).max(), np.abs(mine + true).max()) < 1e-9
        assert abs(by[0, c + 1].explained - values[c] / trace) < 1e-9 and by[0, c + 1].identity_error < 1e-9
        assert abs(by[None, c + 1].whitened - by[5, c + 1].whitened) < 1e-12
    assert [by[i, 1].deviation for i in range(300)] == exact.tolist()


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert wh.whitened(spark.createDataFrame([], schema)).collect() == []
    assert wh.whitened(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []
    same = wh.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0])], schema)).collect()
    assert len(same) == 4 and all(r.whitened is None and r.deviation == 0 and r.n == 1 for r in same)
    ragged = wh.whitened(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, [3.0, 0.0])], schema)).collect()
    assert len(ragged) == 6 and abs(sum(r.explained for r in ragged if r.vec_id == 1) - 1) < 1e-9
    huge = wh.whitened(spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0])], schema)).collect()
    assert len(huge) == 4 and huge[0].deviation is None
    line = wh.whitened(spark.createDataFrame([(i, [float(i)] * 70) for i in range(5)], schema)).collect()  # one component of 70 varies
    assert {(r.component, r.whitened is None) for r in line} == {(1, False), (2, True), (3, True), (4, True)}


def test_filter_finds_close_and_equal_eigenvalues():
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    values = np.concatenate([[5, 5, 4.999, 4.99, 4.98], np.linspace(4.9, 0, 195)])
    matrix = (q * values) @ q.T
    got, vectors = wh.leading(lambda b: matrix @ b, 200, 4)
    assert np.abs(got - values[:4]).max() < 1e-10 and np.abs(matrix @ vectors - vectors * got).max() < 1e-10


# ------------------------------------------------------------------ trie


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    sequence = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        sequence[c] = own.get(base, [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in sequence.items():
        for k in range(len(v) + 1):
            members[tuple(v[:k])].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for k in range(len(p) + 1):
            saved[p[:k]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
            leaves[p[:k]] += p not in children
    ends = lambda p, m: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(sequence[c]) == len(p)).encode()).hexdigest()
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], ends(p, m)) for p, m in members.items()]


def talk():
    rng = random.Random(8)
    rows = []
    for c in [*range(0, 60), *range(100, 130), 200, 250, -7, -100, 31_337]:
        for t in range(rng.choice([1, 2, 3, 7, 8, 9, 40]) if c != 200 else 300):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["ja", "nein", "vielleicht"])))
    rows += [(None, 1, "user", "x"), (5, None, "user", None), (5, None, None, "é"), (6, 1, "user", "ja"), (6, 1, "user", "ja"), (300, 0, "u", ""), (399, 0, "u", "own")]
    return rows


def test_trie_against_brute_force_and_sql(spark):
    rows = talk()
    schema = "conv_id long, turn long, role string, text string, name string, depth int"
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    got = Counter(map(tuple, pt.prefix_trie(df).collect()))
    assert got == Counter(brute_trie(rows))
    con = duckdb.connect()
    conversations = df.toPandas()  # noqa: F841
    conversations["turn"] = conversations["turn"].astype("Int64")
    conversations["conv_id"] = conversations["conv_id"].astype("Int64")
    con.register("conversations", conversations)
    assert Counter(con.execute(pt.ORACLE).fetchall()) == got


def test_trie_of_one_turn_and_none(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert pt.prefix_trie(spark.createDataFrame([], schema)).collect() == []
    for rows in ([(7, 0, "u", "hi")], [(c, 0, "u", "hi") for c in range(40)], [(300, 0, "u", "a"), (301, 0, "u", "b")]):
        assert Counter(map(tuple, pt.prefix_trie(spark.createDataFrame(rows, schema)).collect())) == Counter(brute_trie(rows))
