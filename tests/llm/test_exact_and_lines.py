import hashlib
import random

import pytest

from foliant.llm import exact_dedup as ed
from foliant.llm import line_dedup as ld

SCHEMA = "doc_id long, text string, best string, t string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)


def test_exact_keeps_longest_then_smallest_id(spark):
    rows = [(3, "a b"), (2, "ab"), (1, "a  b"), (4, "c"), (5, None), (6, " \t\n\x0b"), (None, "c"), (7, "a  b")]
    out = {r.doc_id: r for r in ed.exact_dedup(docs(spark, rows)).collect()}
    assert [out[i].keep_id for i in (1, 2, 3, 7)] == [1, 1, 1, 1] and out[1].group_size == 4
    assert out[1].kept and not out[7].kept
    assert out[4].keep_id == 4 and out[None].keep_id == 4 and not out[None].kept and out[4].kept
    assert out[5].keep_id == 6 and out[5].text_sha256 == hashlib.sha256(b"").hexdigest()


def test_exact_heavy_and_light_agree(spark):
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else str(rng.randrange(40))) for i in range(600)]
    a = sorted(map(tuple, ed.exact_dedup(docs(spark, rows), tracked=64, heavy=2).collect()))
    first = {}
    for i, t in rows:
        first.setdefault(t, []).append(i)
    assert [(x[0], x[1], x[2]) for x in a] == [(i, first[t][0], len(first[t])) for i, t in rows]


def test_exact_keeps_one_row_of_each_group(spark):
    import duckdb

    rows = [(1, "a b"), (1, "ab"), (2, "x"), (2, "x"), (2, "x"), (3, "c d"), (3, "cd "), (None, "z"), (None, "z"), (7, None), (7, ""), (8, "hot")] + [(8, "hot")] * 200 + [(9, "h o t")] * 100
    for tracked, heavy in ((ed.TRACKED, ed.HEAVY), (4, 1)):
        out = ed.exact_dedup(docs(spark, rows), tracked=tracked, heavy=heavy).collect()
        assert len(out) == len(rows)
        kept = [r for r in out if r.kept]
        assert len(kept) == len({r.text_sha256 for r in out}) and all(r.doc_id == r.keep_id for r in kept)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(ed.ORACLE).fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in out)


def test_exact_empty_table(spark):
    assert ed.exact_dedup(docs(spark, [])).collect() == []


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def brute_lines(rows):
    seen, out = {}, {}
    order = sorted((i is None, i or 0, no, line.strip(" \t\n\x0b\x0c\r")) for i, t in rows for no, line in enumerate((t or "").split("\n")))
    for miss, i, no, line in order:
        if not line:
            continue
        exact = line in seen
        near = not exact and any(abs(len(o) - len(line)) <= 1 and edits(line, o) <= 1 for o in seen)
        seen[line] = True
        if exact or near:
            out.setdefault(None if miss else i, []).append((no, exact))
    return out


def test_lines_against_brute_force(spark):
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.choice((1, 2, 3, 5, 15, 16, 17, 40, 300)))) for _ in range(12)]

    def mutate(s):
        for _ in range(rng.choice((0, 0, 1, 1, 2))):
            p, c = rng.randrange(len(s) + 1), rng.choice("abcxé")
            s = rng.choice((s[:p] + c + s[p + 1 :], s[:p] + s[p + 1 :], s[:p] + c + s[p:]))
        return s

    rows = [(i, "\n".join(mutate(rng.choice(base)) for _ in range(4))) for i in range(60)] + [(None, base[0]), (100, None), (101, ""), (102, "\n\n")]
    want = brute_lines(rows)
    got = {r.doc_id: r for r in ld.line_report(docs(spark, rows)).collect()}
    for i, t in rows:
        dropped = want.get(i, [])
        assert got[i].dropped == ",".join(str(n) for n, _ in sorted(dropped)), i
        assert got[i].n_exact == sum(e for _, e in dropped) and got[i].n_lines == len((t or "").split("\n"))


@pytest.mark.parametrize("length", [2047, 2048, 2049, 5000])
def test_long_lines_in_segments(spark, length):
    rng = random.Random(length)
    a = "".join(rng.choice("abcdefgh") for _ in range(length))
    rows = [(1, a)] + [(i + 2, v) for i, p in enumerate((0, 1, length // 2, length - 1)) for v in (a[:p] + "Z" + a[p + 1 :],)] + [(20, a[: length // 3] + a[length // 3 + 1 :]), (21, a + "Z"), (22, a[::-1])]
    got = {r.doc_id: r.n_near for r in ld.line_report(docs(spark, rows)).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 1, 5: 1, 20: 1, 21: 1, 22: 0}


def test_short_lines_are_near_as_well(spark):
    rows = [(1, "fourteen chars\n}"), (2, "fourteen chart\n]"), (3, "fourteen charts"), (4, "fourteen xharx"), (5, "ab\n;;;;")]
    got = {r.doc_id: (r.n_near, r.dropped) for r in ld.line_report(docs(spark, rows)).collect()}
    assert got == {1: (0, ""), 2: (2, "0,1"), 3: (1, "0"), 4: (0, ""), 5: (0, "")}


def test_dedup_lines_rebuilds_texts(spark):
    rows = [(1, "one line of text here\nb"), (2, "one line of text here"), (3, "one line of text hare\nnew"), (4, None)]
    out = {r.doc_id: r for r in ld.dedup_lines(docs(spark, rows)).collect()}
    assert set(out) == {1, 3, 4} and out[3].text == "new" and out[4].text is None and out[1].best == "x"
    assert ld.dedup_lines(docs(spark, [])).collect() == []


def test_repeated_rows_lose_their_lines(spark):
    rows = [(1, "one line of text here\nb")] * 3 + [(1, "other text\n\nb"), (2, "xxxx\n\nyyyy"), (2, "xxxx\n\nyyyy"), (3, None), (3, None), (None, "one line of text hers"), (None, "one line of text hers")]
    got = sorted((str(r.doc_id), r.n_lines, r.n_exact, r.n_near, r.n_kept, r.dropped) for r in ld.line_report(docs(spark, rows)).collect())
    first, again = ("1", 2, 0, 0, 2, ""), ("1", 2, 2, 0, 0, "0,1")
    swapped = {("1", 2, 1, 0, 1, "1"), ("1", 3, 1, 0, 2, "2")}  # which of the two texts of document 1 is first is up to their hashes
    assert [x for x in got if x[0] == "2"] == [("2", 3, 0, 0, 3, ""), ("2", 3, 2, 0, 1, "0,2")] and got.count(again) == 2 and swapped & set(got) and (first in got or ("1", 2, 1, 0, 1, "1") in got)
    assert [x for x in got if x[0] == "3"] == [("3", 1, 0, 0, 1, "")] * 2 and [x for x in got if x[0] == "None"] == [("None", 1, 0, 1, 0, "0"), ("None", 1, 1, 0, 0, "0")]
    left = sorted((str(r.doc_id), r.text) for r in ld.dedup_lines(docs(spark, rows)).collect())
    assert [x[0] for x in left] == ["1", "1", "2", "3", "3"] and sum(t is not None and "b" in t.split("\n") for _, t in left) == 1


def test_a_blank_table_and_columns_named_alike(spark):
    d = spark.createDataFrame([(1, " \n", 5, "g"), (1, " \n", 5, "g"), (2, "", 6, "h")], "doc_id long, text string, again int, gone string")
    assert sorted(r.doc_id for r in ld.dedup_lines(d).collect()) == [1, 1, 2] and ld.dedup_lines(d).columns == d.columns
