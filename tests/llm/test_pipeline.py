import random

import pytest

import __spark_entry__ as entry


@pytest.fixture
def corpus(spark, tmp_path):
    rng = random.Random(11)
    line = lambda k: " ".join(f"w{rng.randrange(3000)}" for _ in range(k))
    rows = [(i, "\n".join(line(20) for _ in range(5)), "en", f"s{i % 3 if i % 2 else 0}") for i in range(60)]
    near = rows[0][1].split()
    near[3] = "changed"
    near = " ".join(near)
    rows += [(100, rows[1][1], "en", "s1"), (101, near, "en", "s1"), (102, "tiny", "en", "s2"), (103, "spam spam spam " * 50, "en", "s2"), (104, None, None, None)]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path), rows


def test_stages(spark, corpus):
    import corpus_pipeline as cp

    sf_dir, rows = corpus
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    columns = docs.columns
    for k, (name, stage) in enumerate(cp.STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(cp.STAGES) - 1:
            docs = cp.stored(docs, "test")
            assert docs.columns == columns, name
            seen.append([r.doc_id for r in docs.collect()])
    clean = set(range(60))
    assert set(seen[0]) == clean | {100, 101}  # quality rules: tiny, spam and null go
    assert set(seen[1]) == clean | {101}  # every line of 100 is in document 1
    assert set(seen[2]) == clean  # 101 is a near copy of 0
    assert set(seen[3]) == clean  # mixing repeats, and loses none
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == clean and sum(r.length for r in pieces if r.start == 0) > 0
    assert sorted(r.doc_row for r in pieces if r.start == 0) == sorted({r.doc_row for r in pieces}) and len({r.doc_row for r in pieces}) == len(seen[3])


def test_registered():
    q = entry.queries()
    assert {f"op{i}_" for i in range(1, 14)} == {n[: n.index("_") + 1] for n in q if n.startswith("op")} and "pipeline" in q
    assert set(entry.oracle_sql()) <= set(q)


def through(spark, docs, columns):
    import corpus_pipeline as cp

    seen = []
    for k, (_, stage) in enumerate(cp.STAGES):
        docs = cp.stored(stage(spark, docs, ""), "test")
        if k < len(cp.STAGES) - 1:
            assert docs.columns == columns
        seen.append(docs)
    return seen


def test_stages_on_no_rows(spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert [d.count() for d in through(spark, docs, columns)] == [0] * 5


def test_stages_on_repeated_long_and_clashing_rows(spark):
    rng = random.Random(12)
    line = lambda k: " ".join(f"w{rng.randrange(5000)}" for _ in range(k))
    rows = [(i, "\n".join(line(20) for _ in range(5)), "en", f"s{i % 2}") for i in range(40)]
    long = "\n".join(line(40) for _ in range(9_000))  # about 2 MB
    rows += [rows[0]] * 30 + [(rows[1][0], rows[2][1], "en", "s1")] + [(90, long, "en", "s0"), (91, long + "\n" + line(30), "en", "s0"), (None, "\n".join(line(20) for _ in range(5)), None, None), (92, None, "en", "s0"), (92, None, "en", "s0")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, label string, row int, node long, length long"
    docs = spark.createDataFrame([(*r, len(r[1] or ""), "x", 1, 2, 3) for r in rows], schema)
    seen = through(spark, docs, docs.columns)
    ids = lambda d: sorted(str(r.doc_id) for r in d.select("doc_id").collect())
    assert "92" not in ids(seen[0]) and ids(seen[0]).count("0") == 31
    assert ids(seen[1]).count("0") == 1 and "90" in ids(seen[1]) and "None" in ids(seen[1])
    kept = ids(seen[2])
    assert kept.count("1") == 2 and "2" not in kept and len(kept) == len(set(kept)) + 1  # the other text of document 1 comes before its copy
    assert "90" in kept and set(ids(seen[3])) == set(kept)
    pieces = seen[4].collect()
    tokens = {}
    for p in pieces:
        tokens[p.doc_row] = tokens.get(p.doc_row, 0) + p.length
    assert all(tokens[p.doc_row] == p.doc_tokens for p in pieces) and max(p.doc_tokens for p in pieces) > 100_000
