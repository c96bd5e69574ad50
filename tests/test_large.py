"""What decides at size: measured broadcasts, shuffle files, tables that are no longer read."""

from __future__ import annotations

import random
from pathlib import Path

from pyspark.sql import functions as F

from foliant.operators import regions, trigrams
from foliant.sources import folders
from foliant.sources.scratch import release, saved


def test_small_files_of_many_rows_are_not_broadcast(spark):
    page = F.expr("id div 10").alias("doc_id"), (F.col("id") % 10).cast("int").alias("page_index")
    a = saved(spark.range(1_000_000).select(*page), "many").withColumn("x", F.lit(1))
    b = saved(spark.range(1_000_000).select(*page, F.lit("toc").alias("section")), "repeated")
    assert sum(p.stat().st_size for p in Path(b._saved_at.removeprefix("file:")).rglob("*.parquet")) < 10 * 2**20  # Spark's limit for a broadcast
    joined = a.join(b, ["doc_id", "page_index"], "left")
    assert joined.count() == 1_000_000
    plan = joined.groupBy("section").count()
    assert [tuple(r) for r in plan.collect()] == [("toc", 1_000_000)]
    assert "BroadcastHashJoin" not in plan._jdf.queryExecution().executedPlan().toString()


def test_a_side_of_few_rows_is_still_broadcast(spark):
    a, b = saved(spark.range(1_000), "some"), saved(spark.range(10), "few")
    plan = a.join(b, "id").groupBy().count()
    assert plan.collect()[0][0] == 10
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


def test_shuffle_files_go_with_the_query(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = lambda: {f for f in (disk.getAllFiles().apply(i).getName() for i in range(disk.getAllFiles().size())) if f.startswith("shuffle_")}
    before = files()
    out = saved(spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert not files() - before
    assert out.count() == 7
    release(out)
    assert not Path(out._saved_at.removeprefix("file:")).exists()


SEGMENTS = "page_id long, segment_id long, kind string, x0 double, y0 double, x1 double, y1 double"


def test_tables_of_whole_pages_are_those_of_the_general_way(spark):
    draw = random.Random(5)
    rows = []
    for page in range(120):
        for i in range(draw.choice((1, 2, 9, 40, 150))):  # pages beyond what is grouped at once among them
            x, y, n = draw.uniform(0, 900), draw.uniform(0, 900), draw.uniform(20, 160)
            rows.append((page, i, "h", x, y, x + n, y) if i % 2 else (page, i, "v", x, y, x, y + n))
    # odd rows: an id twice, a side turned round, a null, no number
    rows += [(0, 0, "v", 5.0, 5.0, 5.0, 500.0), (1, 900, "h", 400.0, 50.0, 100.0, 50.0), (2, None, "h", 1.0, 1.0, 500.0, 1.0), (3, 900, "h", float("nan"), 1.0, 500.0, 1.0), (4, 900, None, 1.0, 1.0, 500.0, 1.0)]
    s = spark.createDataFrame(rows, SEGMENTS).repartition(3)
    size = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    try:
        for batch in (7, size):  # pages that go on in the next batch
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
            got = sorted(tuple(r) for r in regions.drawn_tables(s).collect())
            assert got == sorted(tuple(r) for r in regions._tables(regions._joined_boxes(s, regions.NEAR)).collect()) and len(got) > 50
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))


def test_small_pages_are_not_grouped_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(regions, "components", None)
    s = spark.createDataFrame([(p, i, "hv"[i], 0.0, 0.0, 200.0 * (1 - i), 200.0 * i) for p in range(9) for i in (0, 1)], SEGMENTS)
    assert sorted((r.page_id, r.lines) for r in regions.drawn_tables(s).collect()) == [(p, 2) for p in range(9)]
    assert regions.drawn_tables(s.limit(0)).collect() == []


def test_many_small_folders_are_not_a_task_each(spark, tmp_path):
    for i in range(600):
        (tmp_path / f"src/{i}").mkdir(parents=True)
        (tmp_path / f"src/{i}/__init__.py").write_text("x\n")
    files = folders.list_files(spark, str(tmp_path))
    assert files.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism + 1
    assert sorted(r.path for r in files.collect()) == sorted(f"src/{i}/__init__.py" for i in range(600))


def test_trigrams_of_one_text_meet_in_no_shuffle_and_repeated_keys_count_together(spark, monkeypatch):
    rows = [(1, "abcabc xyz"), (2, ""), (3, None), (4, "ab"), (None, "ÄÄÄÄ 12 12 12"), (5, "ΛΟΣ ΛΟΣ λος İİİ éé a\U0001f600b\U0001f600"), (6, " \n "), (7, "b-c b-c\x00\x00\x00\x00")]
    twice = [(8, "abab"), (8, "bab ab"), (9, "only"), (9, None)]
    plain = lambda x: sorted((str(r.doc_id), [tuple(t) for t in r.top]) for r in x.collect())
    for folded in (False, True):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = trigrams.with_top(docs, "doc_id", "text", 3, folded)
        text = docs.select("doc_id", F.col("text").cast("binary").alias("_text"))
        want = dict(plain(trigrams._by_key(text, "doc_id", 3, folded)))
        assert plain(got) == sorted((str(k), want.get(str(k), [])) for k, _ in rows)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    both = spark.createDataFrame(rows + twice, "doc_id long, text string")
    for few in (trigrams.FEW, 0):  # repeated keys broadcast, and joined by shuffles
        monkeypatch.setattr(trigrams, "FEW", few)
        found = [x for x in plain(trigrams.with_top(both, "doc_id", "text", 2)) if x[0] in ("8", "9")]
        assert found == [("8", [("bab", 2), ("aba", 1)])] * 2 + [("9", [("onl", 1), ("nly", 1)])] * 2
        once = [x for x in plain(trigrams.with_top(both, "doc_id", "text", 2, each=False)) if x[0] in ("8", "9")]
        assert once == [("8", [("bab", 2), ("aba", 1)]), ("9", [("onl", 1), ("nly", 1)])]
