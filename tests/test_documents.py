import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from foliant.operators import checkers, contents, document, elements, layout, loc, music, quality, sheet, tables
from foliant.sources import perception, scratch, sinks


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------ lines of code on a real folder

FILES = {
    "a/x.py": b"# c\r\nx = 1\r\n\r\n",
    "a/latin.js": b"// caf\xe9\nlet a;",
    "b/Makefile": b"all:\n\techo",
    "b/empty.py": b"",
    "b/y.log": b"log",
    "tmp/log1.txt": b"x",
    "vendor/v.go": b"package v\n",
    "env/c.py": b"c",
    "pkg/__init__.py": b"import x\n# y\n",
    "pkg/_private.py": b"p = 1\n",
    "_under/q.sql": b"-- a\nselect 1 -- b\n\n",
    ".github/x.yml": b"a: 1\n",
    "pkg/.hidden.js": b"let a; // b\n/* c\nd */ let e;\n",
    ".gitignore": b"# c\n\ntmp/\n*.log\n",
}
GONE = {"a/p.png": b"\x89PNG\xff", "a/q.MXL": b"PK", "node_modules/z.js": b"x", "b/.next/q.py": b"x", "yarn.lock": b"x", "b/s.min.js": b"x", "coverage/c.js": b"x", "x.map": b"x"}


@pytest.fixture
def folder(tmp_path):
    for name, content in (FILES | GONE).items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    return str(tmp_path)


def test_a_folder_is_read_without_what_is_excluded(spark, folder):
    lines = loc.read_lines(spark, folder)
    got = {}
    for r in lines.collect():
        got.setdefault(r.path, {})[r.line_no] = r.text
    want = {p for p, c in FILES.items() if c}
    assert set(got) == want
    assert [got["a/x.py"][i] for i in range(3)] == ["# c", "x = 1", ""] and got["a/latin.js"] == {0: "// caf", 1: "let a;"} and got["vendor/v.go"] == {0: "package v"}
    f = {r.path: (r.language, r.code, r.comments, r.blanks) for r in loc.files(lines).collect()}
    assert f["a/x.py"] == ("Python", 1, 1, 1) and f["a/latin.js"] == ("JavaScript", 1, 1, 0) and f["b/Makefile"] == ("Other", 2, 0, 0)
    assert f["pkg/__init__.py"] == ("Python", 1, 1, 0) and f["_under/q.sql"] == ("SQL", 1, 2, 1) and f["pkg/.hidden.js"] == ("JavaScript", 2, 2, 0)
    kept = {r.path for r in loc.read_lines(spark, folder, use_ignored=True).select("path").distinct().collect()}
    assert kept == want - {"tmp/log1.txt", "b/y.log"}
    assert {r.pattern for r in loc.read_ignored(spark, folder).collect()} == {"tmp", "*.log"}
    os.remove(f"{folder}/.gitignore")
    assert loc.read_ignored(spark, folder).count() == 0


def test_every_exclusion(spark):
    paths = [f"r/{d}/f.py" for d in loc.EXCLUDED_DIRS] + [f"r/f{b.upper()}" for b in loc.BINARY] + ["r/a.MIN.js", "r/a.map", "r/package-lock.json", "r/yarn.lock", "r/pnpm-lock.yaml", "r/Poetry.lock", "r/Pipfile.lock"]
    fine = ["r/buildings/f.py", "r/.hg/f.py", "r/pdf", "r/map.py", "r/lock.json", "r/.png", "env/a.py"]
    got = {r.path for r in loc.without_excluded(frame(spark, [(p,) for p in paths + fine], "path string")).collect()}
    assert len(loc.EXCLUDED_DIRS) == 17 and len(loc.BINARY) == 29 and len(loc.EXCLUDED_PATTERNS) == 7 and got == set(fine)
    langs = {e: loc.EXTENSIONS[e] for e in loc.EXTENSIONS}
    x = frame(spark, [(f"d.x/f{e}", v) for e, v in langs.items()] + [("d.py/noext", "Other"), ("a/.py", "Other")], "path string, want string")
    assert all(r.want == r.got for r in x.withColumn("got", loc.language(F.col("path"))).collect())


def test_the_report_of_lines(spark, folder):
    text = sinks.loc_report(loc.files(loc.read_lines(spark, folder)), k=2).first().report
    assert "| Total Code LOC | " in text and "- `node_modules/`" in text and "- `.omr`" in text and text.count("\n## ") == 6
    top = text[text.index("## TOP-2 Files by Code LOC") :].split("\n")
    assert top[4].endswith("| `.gitignore` |") and top[5].endswith("| `b/Makefile` |") and len([x for x in top[:8] if x.startswith("| ") and "`" in x]) == 2
    assert "| Total Files | 0 |" in sinks.loc_report(frame(spark, [], "path string, language string, category string, code long, comments long, blanks long")).first().report


# ------------------------------------------------------------------ music files

XML = b"""<?xml version="1.0"?><!DOCTYPE score-partwise PUBLIC "x" "y"><score-partwise><part id="P1"><measure number="1">
<attributes><key><fifths>-1</fifths></key><time><beats>3</beats><beat-type>4</beat-type></time></attributes>
<note><pitch><step>C</step><alter>1</alter><octave>4</octave></pitch><type>half</type></note><note><rest/><type>half</type></note></measure>
<measure number="2"><note><pitch><step>B</step><octave>3</octave></pitch></note></measure></part></score-partwise>"""


def test_scores_are_read_from_files(spark, tmp_path):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("META-INF/container.xml", "<c/>")
        z.writestr("score.xml", XML)
    (tmp_path / "s.mxl").write_bytes(packed.getvalue())
    (tmp_path / "s.musicxml").write_bytes(XML)
    (tmp_path / "bad.mxl").write_bytes(b"no zip")
    (tmp_path / "t.pdf").write_bytes(b"x")
    files = perception.read_files(spark, str(tmp_path), (".mxl", ".musicxml"))
    assert files.count() == 3
    notes = music.parse_musicxml(music.unpacked(files)).collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.number, r.pitch, r.duration) for r in notes) == [(n, m, p, d) for n in ("s.musicxml", "s.mxl") for m, p, d in ((1, "C#4", "half"), (2, "B3", "quarter"))]
    m = sorted((r.path.rsplit("/", 1)[1], r.number, r.time_signature, r.key_signature) for r in music.parse_measures(files.where("path like '%musicxml'")).collect())
    assert m == [("s.musicxml", 1, "3/4", "F"), ("s.musicxml", 2, None, None)]
    assert [r.path.rsplit("/", 1)[1] for r in music.best_scores(files).collect()] == ["bad.mxl"]
    assert [r.path.rsplit("/", 1)[1] for r in music.best_scores(files.where("path not like '%bad%'")).collect()] == ["s.mxl"]


def test_what_a_sheet_suggests(spark):
    staff = "array<struct<top_y:int,bottom_y:int>>"
    images = frame(spark, [(1, [(100, 140)], 600, 800), (2, [], 600, 800), (3, [(100, 140)], 0, 800), (4, [(900, 940)], 600, 800)], f"piece_id int, staves {staff}, width int, height int")
    tokens = frame(spark, [(1, 0, "header", "Allegro"), (1, 1, "header", "6/8"), (1, 2, "header", "3/4"), (2, 0, "header", "common time"), (3, 0, "footer", "2/4"), (4, 0, "header", "5/7")], "piece_id int, seq int, region string, text string")
    hints = sheet.structure_hints(images, tokens)
    assert {r.piece_id: (r.clef, r.time_signature) for r in hints.collect()} == {1: ("G", "6/8"), 2: (None, "4/4"), 3: (None, None), 4: (None, None)}
    m = frame(spark, [(1, 0, None, "C"), (1, 1, "2/4", None), (1, 2, None, "G"), (2, 0, None, None), (3, 0, None, None)], "piece_id int, measure_seq int, time_signature string, key_signature string")
    got = sorted((r.piece_id, r.measure_seq, r.time_signature, r.key_signature) for r in sheet.settled_measures(m, hints).collect())
    assert got == [(1, 0, "2/4", "C"), (1, 1, "2/4", "G"), (1, 2, "2/4", "G"), (2, 0, "4/4", None), (3, 0, "4/4", None)]
    inside = frame(spark, [(50, [(80, 120)]), (49, [(80, 120)]), (151, [(80, 120)]), (10, [])], f"y int, staves {staff}")
    assert [r.in_staff for r in sheet.in_staves(inside).collect()] == [True, False, False, False]
    lines = frame(spark, [(1, 0, "Kai Niemiselle"), (1, 1, "Title One"), (1, 2, "Jean Sibelius 1865"), (1, 3, "Other 1999"), (2, 0, "dedicated to x"), (2, 1, "a name far too long to be the title of anything here")], "piece_id int, line_no int, line string")
    got = {r.piece_id: (r.dedication, r.composer, r.title) for r in sheet.header_fields(lines).collect()}
    assert got == {1: ("Kai Niemiselle", "Other 1999", "Title One"), 2: ("dedicated to x", None, None)}
    found = frame(spark, [(1, "old", "x"), (2, None, "y")], "piece_id int, title string, composer string")
    assert {tuple(r) for r in sheet.settled_metadata(found, frame(spark, [(1, "new"), (2, None)], "piece_id int, title string")).collect()} == {(1, "new", "x"), (2, None, "y")}
    p = frame(spark, [(1, "t", "c", True, "score", 3, 4, 0, 0, 0), (2, None, "c", False, "none", 0, 0, 0, 0, 0), (3, "t", None, True, "score", 3, 4, 1, 1, 9)], "piece_id int, title string, composer string, omr_success boolean, omr_engine string, staff_count int, measure_count int, still_wrong int, without_time int, without_beat int")
    assert {r.piece_id: r.status for r in sheet.status(p).collect()} == {1: "pass", 2: "fail", 3: "warning"}
    assert [r.interline for r in sheet.interline(frame(spark, [(1, 10.0), (1, 0.0), (1, None), (1, 13.0)], "img_id int, interline double")).collect()] == [11.5]


# ------------------------------------------------------------------ tables and layout


def cells(spark, rows):
    return frame(spark, [(t, r, c, s, x) for t, r, c, s, x in rows], "table_id int, row_idx int, col_idx int, cell_seq int, text_raw string")


def test_totals_are_compared_unrounded(spark):
    rows = [(1, 0, ["Total", "0.014", "0.014", "0.014", "0.03"]), (1, 1, ["Total", "0.004", "0.004"]), (1, 2, ["sum", "1", "2", "3.011"]), (1, 3, ["sum", "1"]), (1, 4, ["x", "1", "5"])]
    c = cells(spark, [(t, r, k, 10 * r + k, x) for t, r, xs in rows for k, x in enumerate(xs)])
    assert [(r.row_idx, round(r.expected, 6), r.actual) for r in tables.row_totals(c).collect()] == [(0, 0.042, 0.03), (2, 3.0, 3.011)]


def test_balance_takes_the_last_number_of_the_last_row(spark):
    rows = [(0, ["Vastaavaa yhteensä", "1", "90"]), (1, ["Total assets", "5", "100"]), (2, ["total assets", ""]), (3, ["Total liabilities", "7", "100,4"])]
    got = tables.balance(cells(spark, [(1, r, k, 10 * r + k, x) for r, xs in rows for k, x in enumerate(xs)])).collect()
    assert [(r.assets, r.liabilities, r.severity) for r in got] == [(100.0, 100.4, "ok")]


def test_grids_have_all_columns_and_rows(spark):
    c = cells(spark, [(1, 0, 0, 0, "a"), (1, 0, 6, 1, "g"), (1, 2, 1, 2, "old"), (1, 2, 1, 3, "new"), (2, 0, 0, 0, None)])
    got = {(r.table_id, r.row_idx): r.cells for r in tables.grid(c).collect()}
    assert got == {(1, 0): ["a", "", "", "", "", "", "g"], (1, 1): [""] * 7, (1, 2): ["", "new", "", "", "", "", ""], (2, 0): [""]}
    md = {r.table_id: r.markdown for r in sinks.tables_markdown(tables.grid(c)).collect()}
    assert md[1].split("\n")[1] == "|" + " --- |" * 7 and md[2] == "|  |\n| --- |"
    h = frame(spark, [(1, "<table><tr><td>a</td><td>b</td></tr><TR class=x><td>c<br>d</td></tr></table><track><td>e</td>"), (2, None)], "table_id int, html string")
    assert [(r.row_idx, r.col_idx, r.cell_seq, r.text_raw) for r in tables.cells_from_html(h).orderBy("cell_seq").collect()] == [(0, 0, 0, "a"), (0, 1, 1, "b"), (1, 0, 2, "cd"), (1, 1, 3, "e")]


def test_pages_and_regions(spark):
    p = frame(spark, [(0, "native", 0, 0.3), (1, "scan", 250, 0.9), (2, "mixed", 250, 0.2), (3, "mixed", 0, 0.5)], "page_index int, mode string, dpi int, density double")
    ids = lambda df: sorted(r.page_index for r in df.collect())
    assert ids(layout.for_native_text(p)) == [0, 2, 3] and ids(layout.for_rendering(p)) == [1, 2] and ids(layout.for_vector_tables(p)) == [0, 3] and ids(layout.first_pages(p, 2)) == [0, 1]
    r = frame(spark, [(0, "table", -5.5, -5.5, 900.9, 20.2), (1, "table", 700.0, 0.0, 800.0, 10.0), (2, "text", 0.0, 0.0, 9.9, 50.0), (3, "table", 0.0, 0.0, 9.9, 5.0), (4, "text", 5.0, 5.0, 15.0, 15.0)], "region_idx int, type string, x0 double, y0 double, x1 double, y1 double").withColumns({"width": F.lit(600), "height": F.lit(400)})
    assert {c.region_idx: (c.x0, c.y0, c.x1, c.y1) for c in layout.crops(r).collect()} == {0: (0, 0, 600, 20), 3: (0, 0, 9, 5), 4: (5, 5, 15, 15)}
    o = frame(spark, [(1, 0, "text", 5.0), (1, 1, "table", 5.0), (1, 2, "text", 1.0)], "page int, region_idx int, type string, y0 double")
    assert [x.region_idx for x in layout.region_order(o, ["page"]).orderBy("rank").collect()] == [2, 1, 0]
    b = frame(spark, [(1, 0, "a"), (1, 1, " \n"), (1, 2, "b"), (2, 5, "c")], "page int, seq int, text string")
    assert sorted((x.page, x.seq, x.block_no) for x in elements.numbered(b, ["page"]).collect()) == [(1, 0, 0), (1, 2, 1), (2, 5, 0)]
    s = frame(spark, [("toc", 0.9, "notes", None, 0.0), ("appendix", 0.1, "notes", "balance_sheet", 0.9), ("appendix", 0.1, None, "balance_sheet", 0.9), ("notes", 0.8, None, None, 0.0)], "section string, confidence double, target string, hard string, hard_confidence double")
    assert [(x.section, x.confidence) for x in elements.settled_sections(s).collect()] == [("toc", 0.9), ("notes", 0.85), ("balance_sheet", 0.9), ("notes", 0.8)]
    q = frame(spark, [("bad", False), ("good", True), ("good", False)], "status string, noisy boolean")
    assert quality.needs_retry(q).count() == 2


# ------------------------------------------------------------------ whole documents

ITEM = "doc_id int, page_index int, seq int, kind string, text string, y0 double, y1 double, bold boolean, semantic_type string"


def test_a_document_is_classified_and_checked(spark):
    texts = {0: ["Vuosikertomus 2024"], 1: ["Sisällys", "1.1 Tase .... 3", "1.2 Tuloslaskelma .... 4"], 2: ["x", "see note 3"], 3: ["y", "4"], 4: ["z", "5"], 5: ["Liitetiedot", "7. Selite"], 6: ["aaaaaaaaaaaa"]}
    items = frame(spark, [(1, p, s, "block", t, 800.0 if t.isdigit() else 100.0, 815.0 if t.isdigit() else 115.0, False, "list_item" if p == 1 and s else None) for p, ts in texts.items() for s, t in enumerate(ts)] + [(1, 3, 9, "table", None, 300.0, 400.0, False, None)], ITEM)
    c = frame(spark, [(1, 3, 9, r, k, 3 * r + k, x) for r, xs in enumerate((["Vastaavaa yhteensä", "100"], ["Vastattavaa yhteensä", "200"], ["sum", "1", "3"])) for k, x in enumerate(xs)], "doc_id int, page_index int, seq int, row_idx int, col_idx int, cell_seq int, text_raw string")
    documents = frame(spark, [(1, "a.pdf"), (2, None)], "doc_id int, pdf string")
    pages = document.with_quality(frame(spark, [(1, p, 0.0 if p == 4 else 595.0, 842.0) for p in texts], "doc_id int, page_index int, width double, height double"), quality.page_text(items.where("kind = 'block'"), document.PAGE))
    s = document.classified_pages(documents, pages, items, c)
    got = {r.page_index: (r.section, r.confidence, r.offset) for r in s.collect()}
    # pages 3 and 4 show numbers 4 and 5: the offset is -1, and the contents' 3 and 4 are pages 2 and 3
    assert got == {0: ("cover", 0.9, -1), 1: ("toc", 0.85, -1), 2: ("balance_sheet", 0.85, -1), 3: ("income_statement", 0.85, -1), 4: ("appendix", 0.3, -1), 5: ("notes", 0.8, -1), 6: ("appendix", 0.3, -1)}
    t = document.classified_items(items, c, s)
    by = {(r.page_index, r.seq): r for r in t.collect()}
    assert by[1, 1].financial_type == "balance_sheet" and by[1, 1].toc_target_page == 3 and by[1, 1].pdf_target_page == 2 and by[1, 1].evidence == "toc_entry:1.1 Tase .... 3"
    assert by[3, 9].financial_type == "balance_sheet" and by[3, 9].semantic_type == "table" and by[5, 0].financial_type == "notes" and by[0, 0].semantic_type == "title"
    typed = t.join(items.select(*document.TABLE, "text"), document.TABLE)
    found = checkers.findings(checkers.Model(documents, pages, typed, c, s, pages.where("page_index < 6"), t.where("page_index < 5")), checkers.standard())
    said = {(r.doc_id, r.checker, r.severity, r.reason) for r in found.collect()}
    assert said == {
        (2, "schema", "error", "no PDF metadata"), (2, "schema", "error", "no pages"), (1, "schema", "error", "page without extent"), (1, "sums", "warning", "row 2 does not add up"),
        (1, "quality", "warning", "1 bad pages, worst: 6"), (1, "quality", "warning", "1 noisy pages: 6"),
        (1, "balance", "error", "assets and liabilities differ"), (1, "references", "warning", "note is missing, mentions: 2"), (1, "references", "info", "0 of 1 notes found"),
        (1, "snapshot", "warning", "items changed on 2 pages: p5:2>0, p6:1>0"), (1, "snapshot", "warning", "financial types changed"), (1, "snapshot", "info", "page quality changed"), (1, "snapshot", "info", "7 pages, before 6; changed 2"),
    }
    broken = checkers.findings(checkers.Model(documents, pages.withColumn("width", F.raise_error(F.lit("x")).cast("double")), typed, c.drop("cell_seq"), s, pages, t), checkers.standard()).collect()
    assert {(r.doc_id, r.checker, r.reason) for r in broken if r.severity == "error" and "failed" in r.reason} == {(d, k, f"check failed: {e}") for d in (1, 2) for k, e in (("schema", "SparkRuntimeException"), ("sums", "AnalysisException"), ("balance", "AnalysisException"))}
    assert any(r.checker == "references" for r in broken)
    rep = {r.doc_id: r for r in document.reports(documents, c, found).collect()}
    assert not rep[1].schema_valid and rep[1].blank_percent == 0 and [f.checker for f in rep[1].findings] == sorted((f.checker for f in rep[1].findings), key=("schema", "sums", "sections", "quality", "balance", "references", "snapshot").index)


def test_offsets_fall_back(spark):
    d = frame(spark, [(1,), (2,), (3,)], "doc_id int")
    b = frame(spark, [(1, 3 + i, 3 + i, t, 800.0, 815.0, 842.0) for i, t in enumerate(("2", "sivu 3", "Page 3 of 9", "999"))] + [(1, 0, 0, "50", 800.0, 815.0, 842.0)], "doc_id int, page_index int, page_no int, text string, y0 double, y1 double, height double")
    s = frame(spark, [(2, 4, "toc"), (2, 6, "toc"), (3, 0, "cover")], "doc_id int, page_index int, section string")
    assert {r.doc_id: r.offset for r in contents.page_offsets(d, b, s).collect()} == {1: 1, 2: 3, 3: 2}


def test_documents_are_written_and_read_again(spark, tmp_path):
    pages = frame(spark, [(1, 0, "toc"), (1, 1, None)], "doc_id int, page_index int, section string")
    items = frame(spark, [(1, 0, 1, "text", "b"), (1, 0, 0, "title", "A"), (1, 0, 2, "table", None)], "doc_id int, page_index int, seq int, kind string, text string")
    docs = sinks.documents_json(pages, items)
    reports = frame(spark, [(1, True)], "doc_id int, schema_valid boolean")
    sinks.write_documents(docs, reports, str(tmp_path))
    back = sinks.read_documents(spark, f"{tmp_path}/document")
    p, i = sinks.unnested(back)
    assert sorted((r.page_index, r.section) for r in p.collect()) == [(0, "toc"), (1, None)] and sorted((r.seq, r.kind) for r in i.collect()) == [(0, "title"), (1, "text"), (2, "table")]
    assert spark.read.json(f"{tmp_path}/qa_report").first().schema_valid
    with pytest.raises(Exception, match="no items"):
        sinks.write_documents(sinks.documents_json(pages, items.limit(0)), reports, f"{tmp_path}/none")
    assert not os.path.exists(f"{tmp_path}/none")
    table = frame(spark, [(1, 0, 2, "| x |\n| --- |")], "doc_id int, page_index int, seq int, markdown string")
    md = sinks.pages_markdown(items, table, pages).first().markdown
    assert md == "## Page 1\n\n*Section: toc*\n\n### A\n*[#p0_b0]*\n\nb\n*[#p0_b1]*\n\n| x |\n| --- |\n\n*[#p0_t2]*\n\n---\n\n## Page 2\n\n---\n"
    a = frame(spark, [(1, 0, 5, "n")], "doc_id int, page_index int, seq int, text string")
    b = frame(spark, [(1, 0, 0, "o"), (2, 0, 0, "p")], "doc_id int, page_index int, seq int, text string")
    assert sorted((r.doc_id, r.seq, r.source, r.text) for r in document.merged(a, b).collect()) == [(1, 0, "native", "n"), (1, 1, "ocr", "o"), (2, 0, "ocr", "p")]
    assert scratch.saved(a, "x").collect() == a.collect()


def test_sheets_as_markdown(spark, tmp_path):
    piece = frame(spark, [(1, "T", None, "", "q=96", "3/4", "C", None, 4, "f,p", "", 3, 0.65, "score", 7, "warning")], "piece_id int, title string, composer string, dedication string, tempo string, time_signature string, key_signature string, copyright string, measure_count int, dynamics string, expressions string, staff_count int, confidence double, omr_engine string, note_count int, status string")
    b = frame(spark, [(1, 1, "text", "b"), (1, 0, "tempo", "q=96")], "piece_id int, seq int, class string, text string")
    f = frame(spark, [(1, "metadata_composer", "warning")], "piece_id int, check string, severity string")
    md = sinks.sheets_markdown(piece, b, f)
    assert md.first().markdown.split("\n") == ["# Music Sheet Analysis", "", "**Confidence**: 65%", "**Staff Systems**: 3", "", "## Metadata", "- **Title**: T", "- **Tempo**: q=96", "- **Time Signature**: 3/4", "- **Key Signature**: C", "- **Measures**: 4", "", "## Dynamic Markings", "f,p", "", "## Recognition", "- **Engine**: score", "- **Measures**: 4", "- **Notes**: 7", "", "## Checks", "**Status**: WARNING", "- [WARNING] metadata_composer", "", "## Extracted Text Blocks", "- [tempo] q=96", "- [text] b"]
    sinks.write_sheets(piece, md, frame(spark, [("a", b"x")], "path string, content binary"), str(tmp_path))
    assert spark.read.json(f"{tmp_path}/pieces").count() == spark.read.parquet(f"{tmp_path}/scores").count() == 1


def test_smoke_of_a_text(spark):
    got = {r.id: (r.chars_per_word, r.non_alpha_ratio, r.top) for r in quality.smoke(frame(spark, [(1, "abc abc-1"), (2, "  "), (3, None), (4, "!!")], "id int, text string"), "id").collect()}
    assert got == {1: (7 / 3, 2 / 8, "abc:2,bca:1,cab:1"), 2: (0.0, 0.0, ""), 3: (0.0, 0.0, ""), 4: (0.0, 1.0, "")}
