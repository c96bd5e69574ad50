import os
import random

import pytest
from pyspark.sql import functions as F

from foliant.functions.html_tables import html_cells
from foliant.operators import checkers, graph, moves, music, passes, regions, sheet
from foliant.sources import files, folders, incremental, perception
from foliant.streaming import breaker


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------ folders and files


def tree(tmp_path, names):
    for n in names:
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_text(n)


def test_a_folder_is_listed_with_hidden_names_and_without_pruned_folders(spark, tmp_path, monkeypatch):
    names = ["a/__init__.py", "_x/b.txt", ".git2/c", "a/b/c/d/.e", "top", "a/skip/f", "skip/g/h"]
    tree(tmp_path, names)
    os.symlink(tmp_path / "a", tmp_path / "link")
    want = sorted(n for n in names if "skip" not in n)
    for opened in (folders.OPENED, 1):  # all by the driver, and subtrees by tasks
        monkeypatch.setattr(folders, "OPENED", opened)
        rows = folders.list_files(spark, str(tmp_path), ("skip",)).collect()
        assert sorted(r.path for r in rows) == want and all(r.size == len(r.path) for r in rows)
    parts = folders._Reader({"path": str(tmp_path), "skip": '["skip"]'}).partitions()
    assert len([p for p in parts if p.folders]) >= 3  # one for each folder that is left
    read = folders.read_contents(folders.list_files(spark, f"file://{tmp_path}", ("skip",)), str(tmp_path)).collect()
    assert {r.path: bytes(r.content).decode() for r in read} == {n: n for n in want}
    assert folders.list_files(spark, str(tmp_path / "none")).collect() == []
    gone = frame(spark, [("nowhere", 1)], "path string, size long")
    assert folders.read_contents(gone, str(tmp_path)).first().content is None


def names_below(root):
    return sorted(f for _, _, found in os.walk(root) for f in found)


def test_a_file_for_each_row_over_an_earlier_run(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.range(25).selectExpr("concat('d', id % 3, '/', id, '.md') AS name", "CASE WHEN id <> 7 THEN concat('text ', id) END AS content", "1 AS extra")
    for _ in range(2):
        files.write_files(df, root)
        assert names_below(root) == sorted(f"{i}.md" for i in range(25)) and "_staging" not in os.listdir(root)
    read = {r.path.split("/", 1)[1]: bytes(r.content) for r in folders.read_contents(folders.list_files(spark, root), root).collect()}
    assert read["d2/5.md"] == b"text 5" and read["d1/7.md"] == b"" and len(read) == 25
    files.write_files(df.where("name = 'd0/0.md'"), root)
    assert names_below(root) == ["0.md"]
    files.write_files(df.limit(0), root)
    assert names_below(root) == []


def test_a_task_that_fails_leaves_no_file(spark, tmp_path):
    root, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    files.write_files(frame(spark, [("old.md", "o")], "name string, content string"), root)

    @F.udf("string")
    def fails(i):
        if i == 33 and not os.path.exists(mark):
            open(mark, "w").close()
            raise ValueError("once")
        return str(i)

    df = spark.range(60).repartition(6).select(F.concat("id", F.lit(".md")).alias("name"), fails("id").alias("content"))
    with pytest.raises(Exception, match="once"):  # no second attempt in a local session: the job ends
        files.write_files(df, root)
    assert names_below(root) == ["old.md"] and not os.path.exists(f"{root}/_staging")
    files.write_files(df, root)
    assert names_below(root) == sorted(f"{i}.md" for i in range(60))
    for bad in ("../x", "/etc/x", "a//b", "a/./b", ""):
        with pytest.raises(Exception, match="no file can be named so"):
            files.write_files(frame(spark, [(bad, "x")], "name string, content string"), root)
    with pytest.raises(Exception, match="no file can be named so"):
        files.write_files(frame(spark, [("x", "1"), ("x", "2")], "name string, content string"), root)
    assert len(names_below(root)) == 60


def test_an_attempt_that_fails_is_cleared_and_its_second_counts(tmp_path, monkeypatch):
    class Context:
        def partitionId(self):
            return 4

    monkeypatch.setattr(files.TaskContext, "get", staticmethod(Context))
    writer, root = files._Writer(str(tmp_path / "out")), tmp_path / "out"

    def broken():
        yield "a.md", b"1"
        raise OSError("disk")

    with pytest.raises(OSError):
        writer.write(broken())
    assert names_below(root) == []
    twice = [writer.write(iter([("a.md", b"1"), ("b.md", b"2")])) for _ in range(2)]  # the second ran speculatively, and is not committed
    writer.commit(twice[:1])
    assert sorted(os.listdir(root)) == ["part-00004"] and names_below(root) == ["a.md", "b.md"]
    again = files._Writer(str(root))
    again.abort([again.write(iter([("c.md", b"")]))])
    assert names_below(root) == ["a.md", "b.md"] and sorted(os.listdir(root)) == ["part-00004"]


# ------------------------------------------------------------------ scores


def test_scores_beyond_the_plainest_form(spark):
    note = "<note><pitch><step>C</step><octave>4</octave></pitch><type size='cue'>half</type></note>"
    one = f"<score-partwise><part id='A'><measure number='1'/><measure number='2'>{note}</measure><measure/></part><part id='B'><measure number='1'><attributes><divisions>2</divisions></attributes><attributes><time><beats>6</beats><beat-type>8</beat-type></time></attributes>{note}<note><unpitched/></note></measure></part></score-partwise>"
    rows = [("one", one), ("spaced", one.replace("<score-partwise>", "<score-partwise xmlns='urn:x' xmlns:m='urn:m'>").replace("<note>", "<m:note>", 1).replace("</note>", "</m:note>", 1)), ("odd", one.replace("number='2'", "number='X2'")), ("key", one.replace("<time>", "<key><fifths>?</fifths></key><time>")), ("plain", one.replace("<time>", "<key/><time>")), ("cut", one[:100]), ("none", None), ("other", "<container/>")]
    got = {r.path: r for r in music.scores(frame(spark, rows, "path string, content string")).collect()}
    for p in ("one", "spaced"):
        m = got[p].measures
        assert [(x.part, x.number, x.time_signature, [(n.pitch, n.duration) for n in x.notes]) for x in m] == [("A", 2, None, [("C4", "half")]), ("B", 1, "6/8", [("C4", "half")])]
        assert got[p].error is None and got[p].time_signature == "6/8" and got[p].key_signature is None
    assert got["plain"].key_signature == "C" and got["odd"].error == got["key"].error == "a number or key is no integer" and got["odd"].measures == []
    assert got["cut"].error == got["none"].error == "not well-formed" and got["other"].error is None and got["other"].measures == []


def test_the_title_may_be_a_short_token(spark):
    lines = frame(spark, [(1, 0, "Kai Niemiselle"), (1, 1, "Anna Virtanen 1997"), (2, 0, "for two"), (3, 0, "Sonata"), (4, 0, "für alle")], "piece_id int, line_no int, line string")
    tokens = frame(spark, [(1, 0, "Kai"), (1, 1, " 7x7 "), (1, 2, "Op"), (2, 0, "two"), (3, 0, "x"), (4, 0, "a token that is too long")], "piece_id int, seq int, text string")
    got = {r.piece_id: (r.dedication, r.title) for r in sheet.header_fields(lines, tokens).collect()}
    assert got == {1: ("Kai Niemiselle", "7x7"), 2: ("for two", None), 3: (None, "Sonata"), 4: ("für alle", None)}


# ------------------------------------------------------------------ passes and engines


def test_engines_see_what_is_left_to_them(spark):
    r = frame(spark, [(i, "plain words of a page") for i in range(8)], "region_id int, content string")
    seen = []

    def engine(noise):
        def run(x):
            ids = sorted(v.region_id for v in x.collect())
            seen.append(ids)
            return frame(x.sparkSession, [(i, noise.get(i, "plain words")) for i in ids if noise.get(i, "") != "lost"], "region_id int, text string")

        return run

    bad = "e" * 12 + " word"
    engines = [engine({1: bad, 2: bad, 3: bad, 4: "", 5: "lost", 6: "12 .. ,,", 7: "...."}), engine({1: "fine now", 2: "lost", 3: "word " + "o" * 9}), engine({2: "e" * 8 + " ab", 3: "lost"}), engine({2: "end", 3: "lost"})]
    done = passes.adaptive_passes(r, engines)
    assert seen == [list(range(8)), [1, 2, 3, 7], [2, 3], [2, 3]]
    got = {v.region_id: (v.passes, v["pass"], v.text) for v in passes.chosen_passes(done).collect()}
    assert got[0] == (1, 1, "plain words") and got[1] == (2, 2, "fine now") and got[2] == (4, 4, "end") and got[3] == (4, 2, "word " + "o" * 9)
    assert got[4] == (1, 1, "") and got[5] == (1, 1, None) and got[7][0] == 2
    assert passes.adaptive_passes(r.limit(0), engines).count() == 0


def test_pages_that_were_not_read_are_read_by_the_second_engine(spark, tmp_path):
    tree(tmp_path, ["a.pdf", "b.pdf", "c.pdf"])
    found = perception.read_files(spark, str(tmp_path))
    name = lambda p: p.rsplit("/", 1)[1]
    page = lambda i, n: {"page_index": i, "width": 1.0, "height": 1.0, "chars": n, "coverage": 0.0, "density": 0.0}
    first = perception.run_engine(found, lambda p, c: [page(i, 1) for i in range({"a.pdf": 1, "b.pdf": 3}.get(p.rsplit("/", 1)[1], 0))], perception.MANIFEST)
    pages = found.select("path", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("page_index"))
    both = perception.with_fallback(first, found, lambda p, c: [page(i, 2) for i in range(3)], perception.MANIFEST, pages)
    assert sorted((name(r.path), r.page_index, r.chars) for r in both.collect()) == [("a.pdf", 0, 1), ("a.pdf", 1, 2), ("a.pdf", 2, 2), *[("b.pdf", i, 1) for i in range(3)], *[("c.pdf", i, 2) for i in range(3)]]


# ------------------------------------------------------------------ tables that are none


def test_rows_move_from_tables_to_blocks(spark):
    blocks = frame(spark, [(1, 0, 0, "Sisällysluettelo", None), (1, 0, 2, "after", "text"), (1, 1, 0, "x", None), (1, 2, 5, "y", None)], "doc_id int, page_index int, seq int, text string, semantic_type string")
    cell = "doc_id int, page_index int, seq int, row_idx int, col_idx int, cell_seq int, text_raw string"
    cells = frame(spark, [(1, 0, 1, 0, 1, 1, " 4 "), (1, 0, 1, 0, 0, 0, "Tase"), (1, 0, 1, 1, 0, 2, " "), (1, 0, 1, 2, 0, 3, "Liite"), (1, 1, 1, 0, 0, 0, "no"), (1, 1, 1, 0, 1, 1, None), (1, 1, 1, 1, 0, 2, "number"), (1, 1, 2, 0, 0, 0, "a"), (1, 1, 2, 0, 1, 1, "12"), (1, 1, 3, 0, 0, 0, " "), (1, 2, 6, 0, 0, 0, "Tase ..... 3"), (1, 2, 6, 1, 0, 1, "Muut .... 9"), (1, 2, 6, 2, 0, 2, "5")], cell)
    tables = cells.select(*moves.TABLE).distinct().unionByName(frame(spark, [(1, 2, 9)], "doc_id int, page_index int, seq int"))
    b, t, c = moves.refined(blocks, tables, cells)
    got = sorted((r.page_index, r.seq, r.block_id, r.text, r.semantic_type) for r in b.collect())
    assert got == [
        (0, 0, "p0_b0", "Sisällysluettelo", None), (0, 1, "p0_b_toc_0", "Tase 4", "list_item"), (0, 2, "p0_b_toc_2", "Liite", "list_item"), (0, 3, "p0_b2", "after", "text"),
        (1, 0, "p1_b0", "x", None), (1, 1, "p1_b_from_table_1", "no number", "text"),
        (2, 0, "p2_b5", "y", None), (2, 1, "p2_b_toc_0", "Tase ..... 3", "list_item"), (2, 2, "p2_b_toc_1", "Muut .... 9", "list_item"), (2, 3, "p2_b_toc_2", "5", "list_item"),
    ]
    assert [tuple(r) for r in t.collect()] == [(1, 1, 2)] and sorted((r.page_index, r.seq, r.text_raw) for r in c.collect()) == [(1, 2, "12"), (1, 2, "a")]


# ------------------------------------------------------------------ checkers


def test_a_checker_of_ones_own(spark):
    d = frame(spark, [(1, "a.pdf"), (2, None)], "doc_id int, pdf string")
    p = frame(spark, [(1, 0, 595.0, 842.0, "good", 0.9, 1)], "doc_id int, page_index int, width double, height double, status string, score double, repeat_run_max int")
    model = checkers.Model(d, p, d, d, d, p, d)
    c = checkers.standard().without("sums", "sections", "quality", "balance", "references", "snapshot")

    @c.add("wide")
    def wide(m):
        return m.pages.where("width > 500").select("doc_id", "page_index", F.lit("wide page").alias("reason"))

    c.add("broken", lambda m: m.pages.select("no_such_column"))
    c.add("late", lambda m: m.pages.select("doc_id", F.raise_error(F.lit("at work")).alias("reason")))
    got = sorted((r.checker_order, r.checker, r.doc_id, r.page_index, r.severity, r.reason) for r in checkers.findings(model, c).collect())
    assert (1, "wide", 1, 0, "warning", "wide page") in got and (0, "schema", 2, 0, "error", "no PDF metadata") in got
    assert [g[1:3] + g[4:5] for g in got if g[0] > 1] == [("broken", 1, "error"), ("broken", 2, "error"), ("late", 1, "error"), ("late", 2, "error")]
    assert [n for n, _ in checkers.standard()] == ["schema", "sums", "sections", "quality", "balance", "references", "snapshot"]


def test_an_aborted_job_is_no_finding(spark, tmp_path):
    frame(spark, [(1,)], "doc_id int").write.parquet(f"{tmp_path}/t")
    lost = spark.read.parquet(f"{tmp_path}/t")
    for f in os.listdir(f"{tmp_path}/t"):
        os.remove(f"{tmp_path}/t/{f}")
    d = frame(spark, [(1, "a")], "doc_id int, pdf string")
    c = checkers.Checkers()
    c.add("reads", lambda m: lost)
    with pytest.raises(Exception, match="(?i)not exist|FileNotFound|FAILED_READ_FILE"):
        checkers.findings(checkers.Model(d, d, d, d, d, d, d), c)


# ------------------------------------------------------------------ nested tables


def test_cells_of_nested_tables_and_spans(spark):
    html = "<table><tr><th colspan=2>A &amp; B<th>C<tr><td rowspan='2'>x <table><td>in<br>ner<tr><td><b>2</b></table> y<td>1<td>2</tr><tr><td>3<td>4</table>text<table><tr><td colspan=0>last"
    rows = [(1, html), (2, None), (3, "no tables"), (4, "</table></td><td>stray</td>"), (5, "<table><tr><td colspan='9999999999'>w<td rowspan=x>v")]
    got = sorted(tuple("" if v is None else v for v in r) for r in html_cells(frame(spark, rows, "k int, html string"), "k").collect() if r.k in (1,))
    assert got == [
        (1, 0, "", 0, 0, 1, 2, "A & B"), (1, 0, "", 0, 2, 1, 1, "C"), (1, 0, "", 1, 0, 2, 1, "x y"), (1, 0, "", 1, 1, 1, 1, "1"), (1, 0, "", 1, 2, 1, 1, "2"), (1, 0, "", 2, 1, 1, 1, "3"), (1, 0, "", 2, 2, 1, 1, "4"),
        (1, 1, 0, 0, 0, 1, 1, "in ner"), (1, 1, 0, 1, 0, 1, 1, "2"), (1, 2, "", 0, 0, 1, 1, "last"),
    ]
    rest = sorted((r.k, r.col_idx, r.colspan, r.rowspan, r.text_raw) for r in html_cells(frame(spark, rows, "k int, html string"), "k").collect() if r.k != 1)
    assert rest == [(5, 0, 1000, 1, "w"), (5, 1000, 1, 1, "v")]


# ------------------------------------------------------------------ regions


def test_regions_of_sheets(spark):
    staff = "array<struct<top_y:int,bottom_y:int>>"
    rows = [(1, 1000, 800, [(100, 140), (250, 290), (310, 350)]), (2, 1000, 800, []), (3, 100, 30, [(25, 28)]), (4, 0, 800, [])]
    got = sorted(tuple(r) for r in regions.sheet_regions(frame(spark, rows, f"img_id int, width int, height int, staves {staff}")).collect())
    assert got == [(1, "between_staff_0_1", 50, 155, 950, 235), (1, "footer", 0, 390, 1000, 800), (1, "header", 0, 0, 1000, 80), (2, "footer", 0, 736, 1000, 800), (2, "header", 0, 0, 1000, 120), (3, "header", 0, 0, 100, 10)]


def test_components_of_long_paths_and_stars(spark):
    rng = random.Random(4)
    names = list(range(600))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(299)] + [(names[300], names[i]) for i in range(301, 500)] + [(names[500], names[501]), (names[501], names[500]), (names[502], names[502])]
    got = {r.node: r.component for r in graph.components(frame(spark, edges, "a int, b int")).collect()}
    want = {n: min(g) for g in (names[:300], names[300:500], names[500:502]) for n in g}
    assert got == want
    assert graph.components(frame(spark, [], "a int, b int")).collect() == []


def test_two_grids_on_a_page_are_two_tables(spark):
    grid = lambda page, x, y, n, at: [(page, at + i, "h", x, y + 40.0 * i, x + 40.0 * n, y + 40.0 * i) for i in range(n + 1)] + [(page, at + 100 + i, "v", x + 40.0 * i, y, x + 40.0 * i, y + 40.0 * n) for i in range(n + 1)]
    rows = grid(1, 10.0, 10.0, 5, 0) + grid(1, 400.0, 10.0, 4, 1000) + grid(1, 700.0, 700.0, 2, 2000) + [(1, 9000, "h", 0.0, 900.0, 500.0, 900.0)] + grid(2, -300.0, -50.0, 3, 0)
    seg = frame(spark, [(p, i, k, float(a), float(b), float(c), float(d)) for p, i, k, a, b, c, d in rows], "page_id int, segment_id int, kind string, x0 double, y0 double, x1 double, y1 double")
    got = sorted((r.page_id, r.x0, r.y0, r.x1, r.y1, r.lines) for r in regions.drawn_tables(seg).collect())
    assert got == [(1, 10.0, 10.0, 210.0, 210.0, 12), (1, 400.0, 10.0, 560.0, 170.0, 10), (2, -300.0, -50.0, -180.0, 70.0, 8)]
    brute = sum(1 for i, a in enumerate(rows) for b in rows[i + 1 :] if a[0] == b[0] and a[3] <= b[5] + 5 and b[3] <= a[5] + 5 and a[4] <= b[6] + 5 and b[4] <= a[6] + 5)
    assert regions.touching(seg).count() == brute  # each pair once, however many cells it shares
    assert [(r.page_id, r.x0, r.x1) for r in regions.page_tables(seg).orderBy("page_id").collect()] == [(1, 0.0, 780.0), (2, -300.0, -180.0)]


# ------------------------------------------------------------------ streams and kept results


def test_the_breaker_equals_its_fold_after_a_restart(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"e{rng.randrange(6)}", i, rng.choice(["fine"] * 6 + ["failed"] * 3 + ["missing"] * (i % 40 == 0))) for i in range(400)]
    calls = frame(spark, rows, "engine string, call_id long, outcome string")
    source = f"{tmp_path}/in"
    for k, (lo, hi) in enumerate([(0, 3), (3, 120), (120, 121), (121, 400)]):  # the first with an engine's third failure to come
        calls.where(f"call_id >= {lo} and call_id < {hi}").coalesce(1).write.mode("append").parquet(source)
        stream = breaker.breaker(spark.readStream.schema("engine string, call_id long, outcome string").parquet(source))
        run = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        assert run.awaitTermination(120), k
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("engine", "call_id", "called", "failures").collect())
    assert got == sorted(tuple(r) for r in breaker.folded(calls).collect())
    n, want = {}, []
    for e, i, o in rows:
        called = n.get(e, 0) < 3
        n[e] = (3 if o == "missing" else n.get(e, 0) + (o == "failed")) if called else 3
        want.append((e, i, called, n[e]))
    assert got == sorted(want)


def test_only_what_changed_is_computed_again(spark, tmp_path):
    folder, seen = f"{tmp_path}/kept", []

    def compute(x):
        seen.append(sorted(r.id for r in x.select("id").collect()))
        return x.select("id", F.length("text").alias("n"))

    rows = {i: "x" * i for i in range(200)}
    run = lambda d, **kw: {r.id: (r.run, r.n) for r in incremental.refresh(frame(spark, list(d.items()), "id int, text string"), "id", ["text"], compute, folder, **kw).collect()}
    assert run(rows) == {i: (0, i) for i in range(200)}
    later = rows | {7: "changed", 300: "new", 9: None}
    del later[11]
    got = run(later)
    assert seen[1] == [7, 9, 300] and got == {i: ((1 if i in (7, 9, 300) else 0), len(t) if t is not None else None) for i, t in later.items()}
    assert run(later, run=1) == got and len(seen) == 2  # committed: not run again
    os.remove(f"{folder}/manifest/run=1/_SUCCESS")  # as if the run had ended before its commit
    assert run(later, run=1) == got and seen[2] == seen[1]
    assert run(later) == got and seen[3] == []
    assert run(rows)[7] == (3, 7) and seen[4] == [7, 9, 11]
    assert len(incremental.results(spark, "id", folder, 0).collect()) == 200


def test_a_stream_of_changes_keeps_the_rest(spark, tmp_path):
    folder, source = f"{tmp_path}/kept", f"{tmp_path}/in"
    compute = lambda x: x.select("id", F.upper("text").alias("t"))
    for rows in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d"), (3, "e")], [(1, "a")]):
        frame(spark, rows, "id int, text string").coalesce(1).write.mode("append").parquet(source)
        run = incremental.refresh_stream(spark.readStream.schema("id int, text string").parquet(source), "id", ["text"], compute, folder, f"{tmp_path}/cp")
        assert run.awaitTermination(120)
    assert sorted((r.id, r.t, r.run) for r in incremental.results(spark, "id", folder).collect()) == [(1, "A", 0), (2, "C", 1), (3, "E", 1)]
