import functools
import os
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from foliant.operators import music
from foliant.plans import document_queries, job_queries  # noqa: F401
from foliant.plans import queries as plans
from foliant.sources import perception, sinks
from foliant.streaming import quality as stream

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
here = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.fixture(scope="module", autouse=True)
def prepared_once():
    """Queries over whole documents share what they prepare: the tests are about their results."""
    names = ("_report", "_typed", "_checked")
    was = {n: getattr(document_queries, n) for n in names}
    for n, f in was.items():
        setattr(document_queries, n, functools.cache(f))
    yield
    for n, f in was.items():
        setattr(document_queries, n, f)


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@here
@pytest.mark.parametrize("name", sorted(document_queries.q.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, DATA)
    out = duck.execute(plans.ORACLES[name])
    names = [c[0] for c in out.description]
    want = sorted(repr(tuple(plain(r[names.index(c)]) for c in sorted(names))) for r in out.fetchall())
    got = sorted(repr(tuple(plain(r[c]) for c in sorted(df.columns))) for r in df.collect())
    assert sorted(df.columns) == sorted(names) and got == want


@here
def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_musicxml(spark):
    xml = """<?xml version="1.0"?><!DOCTYPE score-partwise PUBLIC "x" "y"><score-partwise><part id="P1"><measure number="1">
    <note><pitch><step>C</step><alter>1</alter><octave>4</octave></pitch><voice>2</voice><type>half</type></note><note><rest/><type>half</type></note></measure>
    <measure number="2"><note><pitch><step>B</step><octave>3</octave></pitch></note></measure></part></score-partwise>"""
    got = music.parse_musicxml(spark.createDataFrame([("a", xml)], "path string, content string")).orderBy("measure_seq", "note_seq").collect()
    assert [(r.measure_seq, r.number, r.pitch, r.duration, r.voice) for r in got] == [(0, 1, "C#4", "half", 2), (1, 2, "B3", "quarter", 1)]


def test_sinks(spark, tmp_path):
    pages = spark.createDataFrame([(1, 0, 595.0), (1, 1, 595.0)], "doc_id int, page_index int, width double")
    items = spark.createDataFrame([(1, 0, 1, "text", "b|c"), (1, 0, 0, "title", "A")], "doc_id int, page_index int, seq int, kind string, text string")
    d = sinks.documents_json(pages, items).first()
    assert [[i.text for i in p["items"]] for p in d.pages] == [["A", "b|c"], []] and d.n_items == 2
    sinks.not_empty(sinks.documents_json(pages, items)).collect()
    with pytest.raises(Exception, match="no items"):
        sinks.not_empty(sinks.documents_json(pages, items.limit(0))).collect()
    grid = spark.createDataFrame([(1, 1, ["x|y", None]), (1, 0, ["a", "b"])], "table_id int, row_idx int, cells array<string>")
    assert sinks.tables_markdown(grid).first().markdown == "| a | b |\n| --- | --- |\n| x\\|y |  |"
    for _ in range(2):  # twice the same
        sinks.write_json(items, f"{tmp_path}/blocks", ["page_index"])
    assert spark.read.json(f"{tmp_path}/blocks").count() == 2
    assert sinks.read_snapshot(items, f"{tmp_path}/none").count() == 0
    sinks.write_snapshot(items, f"{tmp_path}/golden")
    assert sinks.read_snapshot(items, f"{tmp_path}/golden").count() == 2


def test_engines_plug_in(spark, tmp_path):
    for n in ("a.pdf", "b.PDF", "c.txt"):
        (tmp_path / n).write_text(n)
    files = perception.read_files(spark, str(tmp_path))

    def engine(path, content):
        if path.endswith("b.PDF"):
            raise ValueError
        return [{"page_index": 0, "width": 1.0, "height": 2.0, "chars": len(content), "coverage": 0.0, "density": 0.0}]

    first = perception.run_engine(files, engine, perception.MANIFEST)
    assert sorted((r.chars or 0, r.error) for r in first.collect()) == [(0, "ValueError: "), (5, None)]
    both = perception.with_fallback(first, files, lambda p, c: [{"page_index": 1}], perception.MANIFEST)
    assert sorted(r.page_index for r in both.collect()) == [0, 1]
    first = first.where("error is null")
    regions = spark.createDataFrame([], perception.REGIONS)
    assert perception.with_full_pages(regions, first.select("path", "page_index", "width", "height")).first().y1 == 2.0


def test_stream(spark, tmp_path):
    schema = "block_id long, source string, at timestamp, text string"
    rows = [(i, "s", f"2024-01-0{1 + i // 3} 10:00:00", "aaaaaaaaaaaa" if i % 3 == 0 else "fine words") for i in range(9)]
    df = spark.createDataFrame(rows, "block_id long, source string, at string, text string").withColumn("at", F.to_timestamp("at"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    s = stream.block_stream(spark, f"{tmp_path}/in", schema)
    q = stream.write(stream.bad_share(s, "at"), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert q.awaitTermination(60)
    q = stream.write(stream.scored(s).select("block_id", "status"), f"{tmp_path}/out2", f"{tmp_path}/cp2")
    assert q.awaitTermination(60)
    time.sleep(0)
    assert spark.read.parquet(f"{tmp_path}/out2").where("status = 'bad'").count() == 3
    assert {(r.blocks, r.bad) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {(3, 1)}
