import random
import re

import pytest
from pyspark.sql import functions as F

from foliant.functions import music as fm
from foliant.functions import text as ft
from foliant.operators import contents, layout, loc, music, qa, quality, tables


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, x {kind}")


def apply(spark, values, f, kind="string"):
    return [r.y for r in column(spark, values, kind).select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def slow_quality(text):
    if not text or not text.strip():
        return "empty", 0, 0.0
    c = text.replace(" ", "").replace("\n", "")
    run = max(len(m[0]) for m in re.finditer(r"(.)\1*", c, re.S))
    tok = re.findall(r"\S+", text.lower())
    words = [t for t in tok if re.match("[a-zäöå]", t)]
    a, d = sum(x.isalpha() for x in c) / len(c), sum(x.isdigit() for x in c) / len(c)
    junk = sum(len(t) <= 3 and not re.fullmatch("[a-zäöå]+", t) and not t.isdigit() for t in tok) / len(tok)
    w = sum(map(len, words)) / len(words) if words else 0
    s = 0.4 * a + 0.3 * (1 - min(junk, 1)) + 0.2 * (1 - min(run / 20, 1)) + 0.1 * min(w / 10, 1)
    bad = run >= 10 or (a < 0.30 and d < 0.05)
    return "bad" if bad else "poor" if s < 0.5 else "fair" if s < 0.7 else "good", run, s


def test_quality_against_a_loop(spark):
    rng = random.Random(1)
    texts = [None, "", "  \n", "1 2 3", "aaaaaaaaaa", "ok fine words here", "!!! ??? ..", "äö å1 2b"] + ["".join(rng.choice("aäb1 2.\n!") for _ in range(rng.randrange(60))) for _ in range(60)]
    got = quality.with_quality(column(spark, texts), "x").orderBy("i").collect()
    for t, r in zip(texts, got, strict=True):
        status, run, score = slow_quality(t)
        assert (r.status, r.repeat_run_max) == (status, run) and r.score == pytest.approx(score), t
    assert got[3].status == "poor" and got[3].score == pytest.approx(0.49)


def test_numbers(spark):
    given = ["1 234", "1.234,56", "(1 234,5)", "(-5)", "12-34", "5 t€", "", None, "7 %", "abc", "5 €"]
    got = apply(spark, given, ft.normalize_number)
    assert [g.value for g in got] == [1234, 1.234, -1234.5, 5, 12, 5, None, None, 7, None, 5]
    assert [got[i].unit for i in (5, 8, 10)] == ["€", "%", "€"]
    assert apply(spark, ["5 t€"], lambda c: ft.normalize_number(c, strict=True))[0].unit == "t€"


def test_text_scalars(spark):
    assert apply(spark, ["a  b­c\n\n\n\nd ", "x"], ft.normalize_text) == ["a bc\n\nd", "x"]
    assert apply(spark, ["Tase .... 134", "x 12345", "a 2024", "a .... 555", "none"], ft.toc_target_page) == [134, 345, 24, None, None]
    assert [t and t.type for t in apply(spark, ["Tase 2023", "cash flow", "Käteisvarat", "Note", "Notes"], ft.financial_type)] == ["balance_sheet", "cash_flow_statement", "balance_sheet", None, "notes"]
    assert apply(spark, ["see note 3", "ks. liite 4"], ft.note_references) == [["3", "3"], ["4", "4"]]
    assert apply(spark, ["abcab", "ab"], lambda c: ft.longest_run(c)) == [1, 1]
    df = column(spark, ["abcd", "é"]).select("i", ft.characters(F.col("x")).alias("c"))
    assert [r.y for r in df.select("i", ft.trigrams("c").alias("y")).orderBy("i").collect()] == [["abc", "bcd"], []]


def test_music_scalars(spark):
    assert apply(spark, [None, "C", "C|", "6/8", "3/8", "5/8", "2/2", "x/y"], fm.beats_per_measure) == [4, 4, 2, 2, 1, 5, 2, 4]
    assert apply(spark, [1.0, 0.7, 3.0, 12.0, 0.75], fm.nearest_duration, "double") == ["quarter", "eighth", "whole", "breve", "quarter"]
    assert apply(spark, ["ff", "poco rit.", "q=120", "12", "700", "Hello"], fm.text_class) == ["dynamic", "expression", "tempo", "measure_number", "text", "text"]
    assert apply(spark, [-7, 0, 3, 9], fm.key_name, "int") == ["Cb", "C", "A", "C"]
    assert apply(spark, [0.0, 8.0, 15.0], fm.scale_factor, "double") == [1.0, 2.5, 1.0]


def cells(spark, rows):
    out = [(t, r, c, 10 * r + c, x) for t, rs in rows.items() for r, cs in enumerate(rs) for c, x in enumerate(cs)]
    return spark.createDataFrame(out, "table_id string, row_idx int, col_idx int, cell_seq int, text_raw string")


def test_tables(spark):
    c = cells(spark, {"a": [["x", "1", "2"], ["Total", "1,5", "2,5", "4,0"], ["Sum", "1", "2", "4"]], "b": [["one"]], "c": [["Tase .... 3", "3"], ["Muut .... 9", "9"]]})
    assert [(r.table_id, r.row_idx) for r in tables.row_totals(c).collect()] == [("a", 2)]
    assert {r.table_id: r.valid for r in tables.validity(c).collect()} == {"a": True, "b": False, "c": True}
    assert {r.table_id: r.is_toc for r in tables.contents_like(c).collect()} == {"a": False, "b": False, "c": True}
    e = tables.exactness(cells(spark, {"a": [["", "x1", "1", None]]})).first()
    assert (e.cells, e.blank, e.unparsed) == (4, 2, 0)
    b = cells(spark, {str(k): [["Vastaavaa yhteensä", x], ["Total liabilities", y]] for k, (x, y) in enumerate([("100", "100"), ("1000,0", "1004"), ("100", "104"), ("100", "200")])})
    assert {r.table_id: r.severity for r in tables.balance(b).collect()} == {"0": "ok", "1": "ok", "2": "warning", "3": "error"}
    t = tables.cells_from_text(spark.createDataFrame([(1, "a b\n\n c")], "table_id int, text string"))
    assert sorted((r.row_idx, r.col_idx, r.text_raw) for r in t.collect()) == [(0, 0, "a"), (0, 1, "b"), (2, 0, "c")]
    assert [r.text_raw for r in tables.cells_from_html(spark.createDataFrame([(1, "<td a=1>x<b>y</b></td><td> z</td>")], "table_id int, html string")).orderBy("cell_seq").collect()] == ["xy", "z"]


def slow_staves(ys):
    i, tops = 0, []
    while i + 5 <= len(ys):
        gaps = [b - a for a, b in zip(ys[i : i + 5], ys[i + 1 : i + 5], strict=False)]
        mean = sum(gaps) / 4
        if all(abs(g - mean) <= 0.3 * mean for g in gaps):
            tops.append(ys[i])
            i += 5
        else:
            i += 1
    return tops


def test_staves(spark):
    rng = random.Random(2)
    given = [[0.0, 10, 20, 30, 40], [0.0, 25, 35, 45, 55, 65], [10.0 * i for i in range(10)], [], [1.0, 2]] + [sorted(rng.sample(range(200), rng.randrange(30))) for _ in range(20)]
    given = [[float(y) for y in ys] for ys in given]
    got = layout.staves(spark.createDataFrame([(i, ys) for i, ys in enumerate(given)], "img_id int, ys array<double>")).orderBy("img_id").collect()
    assert [r.tops for r in got] == [slow_staves(ys) for ys in given]


def test_header_folding_keeps_its_anchor(spark):
    b = spark.createDataFrame([(1, i, float(y), t) for i, (y, t) in enumerate([(0, "a"), (10, "b"), (14, "c"), (20, "d"), (34, "e"), (36, "f")])], "img_id int, seq int, y0 double, text string")
    assert [r.line for r in layout.header_lines(b).orderBy("line_no").collect()] == ["a b c", "d e", "f"]


def test_reading_order(spark):
    rows = [(1, 0, 300.0, 340.0, 30.0), (1, 1, 0.0, 40.0, 30.0), (1, 2, 0.0, 40.0, 10.0), (2, 0, 40.0, 260.0, 50.0), (2, 1, 41.0, 260.0, 20.0)]
    got = layout.reading_order(spark.createDataFrame(rows, "page int, seq int, x0 double, x1 double, y0 double"), ["page"]).collect()
    assert {(r.page, r.seq): (r.column, r.rank) for r in got} == {(1, 2): (0, 0), (1, 1): (0, 1), (1, 0): (1, 2), (2, 1): (0, 0), (2, 0): (0, 1)}


def test_page_mode(spark):
    got = layout.page_mode(spark.createDataFrame([(300, 0.39, 0.0), (49, 0.6, 0.4), (100, 0.1, 0.3)], "chars int, coverage double, density double")).collect()
    assert [(r.mode, r.dpi, r.notes) for r in got] == [("native", 0, "text_ok"), ("scan", 300, "table_suspicion"), ("mixed", 250, "")]


def test_upper_median(spark):
    assert contents.upper_median(column(spark, [1, 2, 3, 4], "int"), "x").first().median == 3
    assert contents.upper_median(column(spark, [5], "int"), "x").first().median == 5


def test_contents_and_sections(spark):
    p = spark.createDataFrame([(0, 2, "Vuosikertomus"), (1, 9, "1.1 Tase .... 3 1.2 Tulos .... 4 1.3 Notes .... 9"), (2, 9, "Hallituksen kertomus"), (9, 3, "x"), (1, 9, "y")], "page_index int, n_items int, text string")
    got = [(r.section, r.confidence) for r in contents.section(contents.contents_pages(p)).collect()]
    assert got == [("cover", 0.9), ("toc", 0.9), ("management_report", 0.8), ("appendix", 0.3), ("appendix", 0.1)]
    e = contents.entries(spark.createDataFrame([(0, 0, "1.1 Tase .... 3"), (0, 1, "Tase .... 7"), (0, 2, "Tase .... 8")], "page_index int, seq int, text string"))
    assert {(r.entry, r.type, r.target) for r in e.collect()} == {("1.1 Tase .... 3", "balance_sheet", 3), ("tase", "balance_sheet", 8)}


def test_checks(spark):
    b = spark.createDataFrame([(1, 0, "see note 3"), (2, 0, "liite 5"), (3, 1, "liite 3")], "block_id int, page_index int, text string")
    n = spark.createDataFrame([("5",)], "note string")
    assert [(r.note, r.mentions, r.first_block) for r in qa.missing_notes(b, n).collect()] == [("3", 3, 1)]
    d = qa.snapshot_diff(column(spark, ["a", "a", "b"]), column(spark, ["a", "b", "c"]), "x")
    assert {(r.x, r.n_now, r.n_before) for r in d.collect()} == {("a", 2, 1), ("c", 0, 1)}
    s = spark.createDataFrame([(1, "cover"), (1, "notes"), (2, None)], "doc int, section string")
    assert {(r.doc, r.missing) for r in qa.missing_sections(s, "doc").collect()} == {(1, "toc"), (2, "cover"), (2, "toc")}

    def broken():
        raise ValueError("x")

    def fails_at_work():
        return qa.finding(b.withColumn("text", F.raise_error(F.lit("x")).cast("string")), "late", "info", F.col("text"))

    assert [r.severity for r in qa.run_checks({"broken": broken, "late": fails_at_work}).collect()] == ["error", "error"]
    out = qa.run_checks({"notes": lambda: qa.finding(qa.missing_notes(b, n), "notes", "warning", "missing", item="note"), "broken": broken}).collect()
    assert [(r.checker, r.severity, r.checker_order) for r in sorted(out, key=lambda r: r.checker_order)] == [("notes", "warning", 0), ("broken", "error", 1)]


def test_rhythm(spark):
    rows = [(1, 0, k, d, "4/4", None) for k, d in enumerate(["half", "half", "half"])] + [(1, 1, 0, "whole", "4/4", "G"), (1, 2, 0, "half", "4/4", "C")]
    n = spark.createDataFrame(rows, "piece_id int, measure_seq int, note_seq int, duration string, time_signature string, key_signature string")
    assert [r.beat for r in music.positions(n).orderBy("measure_seq", "note_seq").collect()] == [0, 2, 4, 0, 0]
    assert {r.measure_seq: r.state for r in music.measures(n).collect()} == {0: "excess", 1: "valid", 2: "short"}
    assert {r.measure_seq: r.key for r in music.filled_keys(n).collect()} == {0: "G", 1: "G", 2: "C"}
    r = music.rhythm_summary(n).first()
    assert (r.measures, r.wrong, r.still_wrong, r.all_valid) == (3, 2, 2, False)


def test_best_pass(spark):
    rows = [(1, 1, "good words in a row"), (1, 2, "good words in a row"), (2, 1, "xxxxxxxxxxxx bad"), (2, 2, "fine text now")]
    got = quality.best_pass(spark.createDataFrame(rows, "region_id int, pass int, text string"))
    assert {(r.region_id, r["pass"]) for r in got.collect()} == {(1, 1), (2, 2)}


def test_lines_of_code(spark):
    files = {
        "a.py": "#!/bin/x\n# c\n\nx = 1\n",
        "b.js": "// c\nlet a = 1; // tail\n/* open\n inside\n close */\nlet u = 'http://x';",
        "c.sql": "-- c\nselect 1 -- tail\n",
        "d.html": "<p>\n<!-- a\nb\n--></p>\n<i>x</i> <!-- t -->",
        "e.h": "int x;",
        "f.json": "{}\n",
    }
    lines = spark.createDataFrame([(p, i, t) for p, text in files.items() for i, t in enumerate(text.split("\n"))], "path string, line_no int, text string")
    got = {r.path: (r.language, r.code, r.comments, r.blanks) for r in loc.files(lines).collect()}
    assert got["a.py"] == ("Python", 1, 2, 2) and got["c.sql"] == ("SQL", 1, 2, 1) and got["e.h"][0] == "C" and got["f.json"] == ("JSON", 1, 0, 1)
    assert got["b.js"] == ("JavaScript", 3, 5, 0)
    assert got["d.html"] == ("HTML", 3, 3, 0)
    assert [r.path for r in loc.top_files(lines, 2).collect()] == ["b.js", "d.html"]
