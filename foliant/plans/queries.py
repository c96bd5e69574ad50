"""Registered queries over the given tables, each beside the DuckDB SQL that states the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions import music as fm
from foliant.functions import text as ft
from foliant.operators import contents, elements, layout, loc, music, qa, quality, sheet, tables, trigrams
from foliant.sources import adapters as ad

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.table(spark, sf_dir, "documents")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents, for work on every character of their texts: a table of few files is dealt out first."""
    return ad.spread(_docs(spark, sf_dir))


# ------------------------------------------------------------------ text quality

#: Quality of a CTE `q_in` (id, text), as `q`.
Q_SQL = r"""
q0 AS (SELECT id, coalesce(text, '') AS t, replace(replace(coalesce(text, ''), ' ', ''), chr(10), '') AS c FROM q_in),
q1 AS (SELECT id, t, length(c) AS chars, length(regexp_replace(c, '\P{L}', '', 'g')) AS alpha, length(regexp_replace(c, '\P{Nd}', '', 'g')) AS digits,
              string_split(c, '') AS l, regexp_extract_all(lower(t), '\S+') AS tok, regexp_full_match(t, '\s*') AS blank FROM q0),
q2 AS (SELECT *, list_concat([1], list_filter(range(2, chars + 1), lambda i: l[i] <> l[i - 1]), [chars + 1]) AS b, list_filter(tok, lambda x: regexp_matches(x, '^[a-zäöå]')) AS w,
              list_filter(tok, lambda x: length(x) <= 3 AND NOT regexp_full_match(x, '[a-zäöå]+') AND NOT regexp_full_match(x, '\p{Nd}+')) AS j FROM q1),
q3 AS (SELECT id, blank, chars, alpha, digits, CASE WHEN chars = 0 THEN 0 ELSE list_max(list_transform(range(2, len(b) + 1), lambda i: b[i] - b[i - 1])) END AS run,
              len(tok) AS tokens, len(w) AS words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, len(j) AS junk FROM q2),
q4 AS (SELECT *, CASE WHEN chars > 0 THEN alpha::double / chars ELSE 0 END AS a, CASE WHEN chars > 0 THEN digits::double / chars ELSE 0 END AS d,
              CASE WHEN tokens > 0 THEN junk::double / tokens ELSE 0 END AS jr, CASE WHEN words > 0 THEN word_chars::double / words ELSE 0 END AS wl FROM q3),
q5 AS (SELECT *, 0.4::double * a + 0.3::double * (1.0::double - least(jr, 1.0::double)) + 0.2::double * (1.0::double - least(run / 20.0::double, 1.0::double)) + 0.1::double * least(wl / 10.0::double, 1.0::double) AS s,
              run >= 10 OR (a < 0.30::double AND d < 0.05::double) AS bad FROM q4),
q AS (SELECT id, CASE WHEN blank THEN 0::double ELSE a END AS alpha_ratio, CASE WHEN blank THEN 0::double ELSE d END AS digit_ratio, CASE WHEN blank THEN 0 ELSE run END::int AS repeat_run_max,
             CASE WHEN blank THEN 0::double ELSE jr END AS junk_token_ratio, CASE WHEN blank THEN 0::double ELSE wl END AS avg_word_len,
             CASE WHEN blank THEN 'empty' WHEN bad THEN 'bad' WHEN s < 0.5 THEN 'poor' WHEN s < 0.7 THEN 'fair' ELSE 'good' END AS status, CASE WHEN blank THEN 0::double ELSE s END AS score, NOT blank AND bad AS noisy FROM q5)"""
_Q_DOCS = "WITH q_in AS (SELECT doc_id AS id, text FROM documents), " + Q_SQL


@query(_Q_DOCS + " SELECT id AS doc_id, alpha_ratio, digit_ratio, repeat_run_max, junk_token_ratio, avg_word_len, status, score FROM q")
def text_quality(spark, sf_dir):
    return quality.with_quality(_texts(spark, sf_dir)).select("doc_id", "alpha_ratio", "digit_ratio", "repeat_run_max", "junk_token_ratio", "avg_word_len", "status", "score")


@query(_Q_DOCS + " SELECT id AS doc_id, repeat_run_max, noisy FROM q")
def noise_gate(spark, sf_dir):
    return quality.with_quality(_texts(spark, sf_dir)).select("doc_id", "repeat_run_max", "noisy")


_VERDICT = "count(*) AS pages, count_if(status = 'bad') AS bad, CASE WHEN count_if(status = 'bad')::double / count(*) > 0.20 THEN 'FAILED' WHEN count_if(status = 'bad')::double / count(*) > 0.10 THEN 'WARNING' ELSE 'PASSED' END AS verdict"


@query(_Q_DOCS + f" SELECT source, {_VERDICT} FROM q JOIN documents ON q.id = doc_id GROUP BY source")
def quality_verdict_by_source(spark, sf_dir):
    return quality.verdict(quality.with_bad(_texts(spark, sf_dir)), ["source"])


@query(_Q_DOCS + " SELECT lang, status, count(*) AS n FROM q JOIN documents ON q.id = doc_id GROUP BY ALL")
def quality_status_hist(spark, sf_dir):
    return quality.with_quality(_texts(spark, sf_dir)).groupBy("lang", "status").agg(F.count("*").alias("n"))


@query(_Q_DOCS + " SELECT id AS doc_id, score, repeat_run_max FROM q WHERE status = 'bad' ORDER BY score, id LIMIT 5")
def worst_pages_topk(spark, sf_dir):
    return quality.worst(quality.with_quality(_texts(spark, sf_dir))).select("doc_id", "score", "repeat_run_max")


_Q_PASSES = f"WITH {ad.PASSES}, q_in AS (SELECT region_id || '/' || pass AS id, text FROM passes), {Q_SQL}"
_BEST = " SELECT p.region_id, p.pass, q.status, q.repeat_run_max FROM passes p JOIN q ON q.id = p.region_id || '/' || p.pass QUALIFY row_number() OVER (PARTITION BY p.region_id ORDER BY CASE WHEN repeat_run_max >= 10 THEN -repeat_run_max WHEN repeat_run_max >= 8 THEN 10 - repeat_run_max ELSE 20 - repeat_run_max END DESC, 0.4::double * alpha_ratio + 0.3::double * (1 - junk_token_ratio) + 0.2::double * least(avg_word_len / 8, 1.0::double) + 0.1::double * score DESC, p.pass, p.text) = 1"


@query(_Q_PASSES + _BEST)
def best_ocr_pass(spark, sf_dir):
    return quality.best_pass(ad.passes(spark, sf_dir)).select("region_id", "pass", "status", "repeat_run_max")


@query(_Q_PASSES + " SELECT pass, status, count(*) AS n FROM passes p JOIN q ON q.id = p.region_id || '/' || p.pass GROUP BY ALL")
def pass_status_hist(spark, sf_dir):
    return quality.with_quality(ad.passes(spark, sf_dir)).groupBy("pass", "status").agg(F.count("*").alias("n"))


_SMOKE = r"""WITH b AS (SELECT doc_id, text, replace(replace(text, ' ', ''), chr(10), '') AS c, regexp_full_match(text, '\s*') AS blank, regexp_extract_all(text, '[\p{L}\p{M}\p{Nd}\p{Pc}]+') AS w FROM documents),
g AS (SELECT doc_id, lower(t) AS t, min(i) AS i, count(*) AS n FROM (SELECT doc_id, i, substr(c, i, 3) AS t FROM (SELECT doc_id, c, unnest(range(1, length(c) - 1)) AS i FROM b WHERE NOT blank)) WHERE regexp_full_match(t, '[\p{L}\p{Nd}]{3}') GROUP BY ALL),
k AS (SELECT doc_id, string_agg(t || ':' || n, ',' ORDER BY n DESC, i) AS top FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, i) AS r FROM g) WHERE r <= 10 GROUP BY doc_id)
SELECT b.doc_id, CASE WHEN blank OR len(w) = 0 THEN 0::double ELSE length(array_to_string(w, ''))::double / len(w) END AS chars_per_word,
       CASE WHEN blank OR length(c) = 0 THEN 0::double ELSE (length(c) - length(regexp_replace(c, '\P{L}', '', 'g')))::double / length(c) END AS non_alpha_ratio, coalesce(top, '') AS top FROM b LEFT JOIN k USING (doc_id)"""


@query(_SMOKE)
def text_smoke(spark, sf_dir):
    return quality.smoke(_texts(spark, sf_dir), "doc_id")


@query("SELECT doc_id, t AS trigram, n FROM (SELECT doc_id, t, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS r FROM (SELECT doc_id, t, count(*) AS n, min(i) AS f FROM (SELECT doc_id, i, substr(text, i, 3) AS t FROM (SELECT doc_id, text, unnest(range(1, length(text) - 1)) AS i FROM documents)) GROUP BY doc_id, t)) WHERE r <= 10")
def trigram_topk(spark, sf_dir):
    d = _texts(spark, sf_dir).select("doc_id", "text")
    top = trigrams.with_top(d, "doc_id", "text", 10, each=False).select("doc_id", F.explode("top").alias("v"))
    return top.select("doc_id", F.col("v.t").alias("trigram"), F.col("v.n").alias("n"))


@query(r"SELECT doc_id, regexp_replace(regexp_replace(replace(regexp_replace(text, ' +', ' ', 'g'), chr(173), ''), chr(10) || '{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS text FROM documents")
def normalize_text(spark, sf_dir):
    return _texts(spark, sf_dir).select("doc_id", ft.normalize_text(F.col("text")).alias("text"))


@query(f"WITH {ad.BLOCKS} SELECT doc_id, page_index, string_agg(text, ' ' ORDER BY seq) AS text FROM blocks GROUP BY ALL")
def page_text(spark, sf_dir):
    return quality.page_text(ad.blocks(spark, sf_dir), ["doc_id", "page_index"])


# ------------------------------------------------------------------ numbers and tables

_NUM = r"""CASE WHEN regexp_full_match({0}, '\s*') THEN NULL ELSE CASE WHEN starts_with(z, '(') AND ends_with(z, ')') THEN -1 ELSE 1 END * try_cast(nullif(regexp_extract(CASE WHEN starts_with(z, '(') AND ends_with(z, ')') THEN regexp_replace(z, '[()]', '', 'g') ELSE z END, '-?[0-9]+\.?[0-9]*'), '') AS double) END"""
_Z = r"regexp_replace(replace(replace(regexp_replace({0}, '^\s+|\s+$', '', 'g'), ' ', ''), ',', '.'), '[€%]', '', 'g')"
_NUMBERS = f"WITH {ad.CELLS}, zs AS (SELECT *, {_Z.format('text_raw')} AS z FROM cells), nums AS (SELECT *, {_NUM.format('text_raw')} AS value_num, CASE WHEN contains(text_raw, '€') THEN '€' WHEN contains(text_raw, '%') THEN '%' END AS unit FROM zs)"


@query(_NUMBERS + " SELECT table_id, cell_seq, value_num, unit FROM nums")
def normalize_numbers(spark, sf_dir):
    return tables.with_numbers(ad.cells(spark, sf_dir)).select("table_id", "cell_seq", "value_num", "unit")


@query(_NUMBERS + r" SELECT count(*) AS cells, count_if(regexp_full_match(text_raw, '\s*')) AS blank, count_if(NOT regexp_full_match(text_raw, '\s*') AND regexp_matches(text_raw, '[0-9]') AND value_num IS NULL) AS unparsed FROM nums")
def cell_exactness(spark, sf_dir):
    return tables.exactness(ad.cells(spark, sf_dir))


@query(f"WITH {ad.CELLS}" + r" SELECT *, columns >= 2 AND numeric * 10 >= cells AS valid FROM (SELECT table_id, count(DISTINCT col_idx) AS columns, count(*) AS cells, count_if(regexp_full_match(trim(text_raw), '[0-9,.()-]+')) AS numeric FROM cells GROUP BY table_id)")
def table_validity(spark, sf_dir):
    return tables.validity(ad.cells(spark, sf_dir))


@query(f"WITH {ad.TOC_LINES}, c AS (SELECT page_index AS table_id, unnest([text, (seq % 600 + 1)::varchar]) AS t FROM toc)" + r" SELECT *, cells >= 3 AND ((dotted::double / cells > 0.1 AND paged::double / cells > 0.1) OR dotted::double / cells > 0.2) AS is_toc FROM (SELECT table_id, count(*) AS cells, count_if(regexp_matches(t, '\.{2,}')) AS dotted, count_if(regexp_full_match(trim(t), '[0-9]{1,3}')) AS paged FROM c GROUP BY table_id)")
def toc_table_detect(spark, sf_dir):
    t = ad.toc_lines(spark, sf_dir)
    c = t.select(F.col("page_index").alias("table_id"), F.explode(F.array("text", (F.col("seq") % 600 + 1).cast("string"))).alias("text_raw"))
    return tables.contents_like(c)


_TOTALS = "list_reduce(list_prepend(0::double, v[:-2]), lambda x, y: x + y)"


@query(_NUMBERS + f""", r AS (SELECT table_id, row_idx, max(CASE WHEN col_idx = 0 THEN lower(text_raw) END) AS label, list(value_num ORDER BY cell_seq) FILTER (col_idx > 0 AND value_num IS NOT NULL) AS v FROM nums GROUP BY ALL)
SELECT table_id, row_idx, {_TOTALS} AS expected, v[-1] AS actual FROM r WHERE regexp_matches(label, 'yhteensä|total|sum|kokonaismäärä') AND len(v) >= 2 AND abs({_TOTALS} - v[-1]) > 0.01::double""")
def row_total_mismatches(spark, sf_dir):
    return tables.row_totals(ad.cells(spark, sf_dir))


@query(f"WITH {ad.CELLS}, m AS (SELECT table_id, max(row_idx) AS mr, max(col_idx) AS mc FROM cells GROUP BY table_id), gr AS (SELECT table_id, mc, r.i AS row_idx, c.i AS col_idx FROM m, LATERAL (SELECT unnest(range(0, mr + 1))::int AS i) r, LATERAL (SELECT unnest(range(0, mc + 1))::int AS i) c) SELECT table_id, row_idx, string_agg(coalesce(text_raw, ''), ' | ' ORDER BY col_idx) AS line FROM gr LEFT JOIN (SELECT table_id, row_idx, col_idx, arg_max(text_raw, cell_seq) AS text_raw FROM cells GROUP BY ALL) USING (table_id, row_idx, col_idx) GROUP BY ALL")
def grid_pivot(spark, sf_dir):
    return tables.grid(ad.cells(spark, sf_dir)).select("table_id", "row_idx", F.array_join("cells", " | ").alias("line"))


@query(f"WITH {ad.CELLS}, f AS (SELECT table_id, lower(text_raw) AS t FROM cells QUALIFY row_number() OVER (PARTITION BY table_id ORDER BY cell_seq) <= 10) SELECT table_id, CASE WHEN bool_or(regexp_matches(t, 'vastaavaa|vastattavaa|varat|velat')) THEN 'balance_sheet' WHEN bool_or(regexp_matches(t, '2023|2024')) AND bool_or(regexp_matches(t, 'tuotot|kulut|tulos')) THEN 'income_statement' ELSE 'unknown' END AS type FROM f GROUP BY table_id")
def table_structure_type(spark, sf_dir):
    return tables.structure_type(ad.cells(spark, sf_dir))


_BALANCE = "CASE WHEN abs(assets - liabilities) <= greatest(abs(assets), abs(liabilities)) * 0.005::double THEN 'ok' WHEN abs(assets - liabilities) < greatest(abs(assets), abs(liabilities)) * 0.005::double * 10 THEN 'warning' ELSE 'error' END AS severity"


@query(f"WITH {ad.BALANCE_CELLS}, z AS (SELECT table_id, row_idx, replace(text_raw, ',', '.')::double AS v FROM balance_cells WHERE col_idx = 2), s AS (SELECT table_id, max(CASE WHEN row_idx = 0 THEN v END) AS assets, max(CASE WHEN row_idx = 1 THEN v END) AS liabilities FROM z GROUP BY table_id) SELECT *, {_BALANCE} FROM s")
def balance_equation(spark, sf_dir):
    return tables.balance(ad.balance_cells(spark, sf_dir))


@query(r"SELECT page_id AS table_id, 0 AS row_idx, (i - 1)::int AS col_idx, (i - 1)::int AS cell_seq, trim(regexp_replace(l[i], '<[^>]+>', '', 'g')) AS text_raw FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1) AS l FROM pages))")
def html_cells(spark, sf_dir):
    return tables.cells_from_html(ad.table(spark, sf_dir, "pages").select(F.col("page_id").alias("table_id"), "html"), "li")


_TD = r"""SELECT table_id, row_idx, (generate_subscripts(l, 1) - 1)::int AS col_idx, (before + generate_subscripts(l, 1) - 1)::int AS cell_seq, unnest(l) AS text_raw FROM (
  SELECT page_id AS table_id, row_idx, [t || ' ' || x FOR x IN w[row_idx * 3 + 1:row_idx * 3 + 3]] AS l, row_idx * 3 AS before FROM (
    SELECT page_id, unnest(range(0, (len(w) + 2) // 3))::int AS row_idx, w, 'x' AS t FROM (SELECT page_id, list_filter(string_split(regexp_extract(html, '<title>([^<]*)</title>', 1), ' '), lambda v: v <> '') AS w FROM pages)))"""


@query(_TD)
def html_table_cells(spark, sf_dir):
    """Titles of pages written as tables of three columns, and read again."""
    w = F.filter(F.split(F.regexp_extract("html", r"<title>([^<]*)</title>", 1), " "), lambda v: v != "")
    p = ad.table(spark, sf_dir, "pages").select(F.col("page_id").alias("table_id"), w.alias("w"))
    cell = lambda x, i: F.concat(F.when(i % 3 == 0, "<tr class=r>").otherwise(""), F.lit("<td class='c'> <b>x</b> "), x, F.lit("</td>"))
    return tables.cells_from_html(p.select("table_id", F.concat(F.lit("<table><thead></thead>"), F.array_join(F.transform("w", cell), ""), F.lit("</table>")).alias("html")))


@query(r"SELECT table_id, row_idx, (generate_subscripts(t, 1) - 1)::int AS col_idx, unnest(t) AS text_raw FROM (SELECT table_id, row_idx, regexp_split_to_array(regexp_replace(line, '^\s+|\s+$', '', 'g'), '\s+') AS t FROM (SELECT item_id AS table_id, (generate_subscripts(a, 1) - 1)::int AS row_idx, unnest(a) AS line FROM (SELECT item_id, string_split(text, chr(10)) AS a FROM benchmark)) WHERE trim(line) <> '')")
def text_cells(spark, sf_dir):
    return tables.cells_from_text(ad.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("table_id"), "text"))


# ------------------------------------------------------------------ layout

_ORDER = f"""WITH {ad.BLOCKS}, a AS (SELECT *, (x0 + x1) / 2 AS c, first_value(x1) OVER (PARTITION BY doc_id, page_index ORDER BY seq) AS w FROM blocks),
b AS (SELECT *, max(c) OVER p - min(c) OVER p AS span FROM a WINDOW p AS (PARTITION BY doc_id, page_index)),
o AS (SELECT *, CASE WHEN span / w < 0.6 THEN 0 WHEN c < w / 2 THEN 0 ELSE 1 END AS col FROM b)
SELECT doc_id, page_index, seq, col AS "column", (row_number() OVER (PARTITION BY doc_id, page_index ORDER BY y0, col, seq) - 1)::int AS rank FROM o"""


@query(_ORDER)
def reading_order(spark, sf_dir):
    return layout.reading_order(ad.blocks(spark, sf_dir), ["doc_id", "page_index"]).select("doc_id", "page_index", "seq", "column", "rank")


@query(f"WITH {ad.BLOCKS} SELECT doc_id, page_index, count(*) AS kept FROM blocks WHERE y0 >= height * 0.1::double AND y1 <= height * 0.9::double GROUP BY ALL")
def header_footer_filter(spark, sf_dir):
    return layout.without_margins(ad.blocks(spark, sf_dir)).groupBy("doc_id", "page_index").agg(F.count("*").alias("kept"))


def _manifest(spark, sf_dir):
    d = F.col("doc_id")
    return _docs(spark, sf_dir).select("doc_id", (F.col("n_chars") % 700).alias("chars"), (d % 10 / 10).alias("coverage"), (d % 7 / 10).alias("density"))


_MODE = """WITH m AS (SELECT doc_id, n_chars % 700 AS chars, doc_id % 10 / 10::double AS coverage, doc_id % 7 / 10::double AS density FROM documents),
k AS (SELECT *, CASE WHEN chars >= 300 AND coverage < 0.40 THEN 'native' WHEN chars < 50 AND coverage >= 0.60 THEN 'scan' ELSE 'mixed' END AS mode FROM m),
o AS (SELECT doc_id, mode, CASE WHEN mode = 'native' THEN 0 WHEN density > 0.3 THEN 300 ELSE 250 END AS dpi, CASE WHEN mode = 'native' THEN 'cpu' ELSE 'gpu' END AS device,
  concat_ws(',', CASE WHEN chars >= 300 THEN 'text_ok' END, CASE WHEN coverage > 0.60 THEN 'scan_like' END, CASE WHEN density > 0.3 THEN 'table_suspicion' END) AS notes FROM k)"""


@query(_MODE + " SELECT * FROM o")
def page_mode(spark, sf_dir):
    return layout.page_mode(_manifest(spark, sf_dir)).select("doc_id", "mode", "dpi", "device", "notes")


@query(_MODE + " SELECT mode, count(*) AS pages, sum(dpi)::bigint AS cost FROM o GROUP BY mode")
def page_mode_hist(spark, sf_dir):
    return layout.page_mode(_manifest(spark, sf_dir)).groupBy("mode").agg(F.count("*").alias("pages"), F.sum("dpi").alias("cost"))


@query("""WITH t AS (SELECT doc_id AS page_id, unnest(range(0, 3))::int AS third FROM documents), p AS (SELECT *, 900.0 * third / 3 AS top, 900.0 * (third + 1) / 3 AS bottom FROM t),
r AS (SELECT doc_id AS page_id, doc_id * 37 % 600 + 0.5 AS y0, doc_id * 37 % 600 + 150.5 AS y1 FROM documents WHERE doc_id % 3 <> 0)
SELECT page_id, third FROM p WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.page_id = p.page_id AND NOT (p.bottom < r.y0 OR p.top > r.y1))""")
def section_table_overlap(spark, sf_dir):
    d = _docs(spark, sf_dir).select(F.col("doc_id").alias("page_id"))
    y = F.col("page_id") * 37 % 600
    return layout.free_thirds(d.withColumn("height", F.lit(900.0)), d.where("page_id % 3 <> 0").select("page_id", (y + 0.5).alias("y0"), (y + 150.5).alias("y1"))).select("page_id", "third")


_STAVES = """WITH RECURSIVE g AS (SELECT vec_id AS img_id, list_transform(embedding, lambda x, i: round(10.0::double * (i - 1) + round(10.0::double + abs(x)::double * 4, 3), 3)) AS ys FROM embeddings),
st(img_id, ys, i, n) AS (SELECT img_id, ys, 1, 0 FROM g UNION ALL
  SELECT img_id, ys, i + CASE WHEN fits THEN 5 ELSE 1 END, n + fits::int FROM (
    SELECT *, list_bool_and([abs(ys[i + k + 1] - ys[i + k] - (ys[i + 4] - ys[i]) / 4) <= 0.3::double * ((ys[i + 4] - ys[i]) / 4) FOR k IN [0, 1, 2, 3]]) AS fits FROM st WHERE i + 4 <= len(ys)))
SELECT img_id, max(n)::int AS n_staves, CASE WHEN max(n) >= 3 THEN least(0.5::double + max(n) / 20::double, 0.95::double) ELSE 0.0::double END AS confidence FROM st GROUP BY img_id"""


@query(_STAVES)
def staff_groups(spark, sf_dir):
    gaps = F.transform("embedding", lambda x: F.round(F.lit(10.0) + F.abs(x).cast("double") * 4, 3))
    ys = F.transform(gaps, lambda g, i: F.round(F.lit(10.0) * i + g, 3))
    v = ad.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("img_id"), ys.alias("ys"))
    return layout.staves(v).select("img_id", "n_staves", layout.sheet_confidence().alias("confidence"))


@query("SELECT label AS img_id, quantile_cont(g, 0.5) AS interline FROM (SELECT label, CASE WHEN e < 0 THEN 0 ELSE round(10.0::double + e::double * 4, 3) END AS g FROM (SELECT label, unnest(embedding) AS e FROM embeddings)) WHERE g <> 0 GROUP BY label")
def interline_by_image(spark, sf_dir):
    e = F.col("e").cast("double")
    x = ad.table(spark, sf_dir, "embeddings").select(F.col("label").alias("img_id"), F.explode("embedding").alias("e"))
    return sheet.interline(x.select("img_id", F.when(e < 0, 0.0).otherwise(F.round(F.lit(10.0) + e * 4, 3)).alias("interline")))


@query("SELECT label, quantile_cont(g, 0.5) AS interline FROM (SELECT label, round(10.0::double + abs(unnest(embedding))::double * 4, 3) AS g FROM embeddings) GROUP BY label")
def interline_median(spark, sf_dir):
    x = ad.table(spark, sf_dir, "embeddings").select("label", F.explode("embedding").alias("e")).select("label", F.round(F.lit(10.0) + F.abs(F.col("e")).cast("double") * 4, 3).alias("g"))
    return x.groupBy("label").agg(F.percentile("g", F.lit(0.5)).alias("interline"))


_HEADER = f"""WITH RECURSIVE {ad.BLOCKS}, o AS (SELECT doc_id, page_index, seq, y0 / 4 AS y, text, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY y0, seq) AS rn FROM blocks),
f(doc_id, page_index, rn, anchor, line_no, text) AS (SELECT doc_id, page_index, rn, y, 0, text FROM o WHERE rn = 1 UNION ALL
  SELECT o.doc_id, o.page_index, o.rn, CASE WHEN abs(o.y - f.anchor) >= 15 THEN o.y ELSE f.anchor END, f.line_no + (abs(o.y - f.anchor) >= 15)::int, o.text
  FROM f JOIN o ON o.doc_id = f.doc_id AND o.page_index = f.page_index AND o.rn = f.rn + 1),
w AS (SELECT f.*, o.seq FROM f JOIN o USING (doc_id, page_index, rn))
SELECT doc_id, page_index, line_no, string_agg(text, ' ' ORDER BY seq) AS line, count(*) AS blocks FROM w GROUP BY ALL"""


@query(_HEADER)
def header_lines(spark, sf_dir):
    b = ad.blocks(spark, sf_dir).select("doc_id", "page_index", "seq", (F.col("y0") / 4).alias("y0"), "text")
    return layout.header_lines(b, keys=("doc_id", "page_index"))


@query(f"WITH {ad.BLOCKS} SELECT doc_id, page_index, seq, (row_number() OVER (PARTITION BY doc_id, page_index ORDER BY seq) - 1)::int AS block_no FROM blocks WHERE NOT regexp_full_match(text, '\\s*')")
def numbered_blocks(spark, sf_dir):
    return elements.numbered(ad.blocks(spark, sf_dir), ["doc_id", "page_index"]).select("doc_id", "page_index", "seq", "block_no")


@query(_MODE + ", g AS (SELECT o.*, m.density FROM o JOIN m USING (doc_id)) SELECT doc_id, mode IN ('native', 'mixed') AS text, mode IN ('scan', 'mixed') AND dpi > 0 AS image, mode IN ('native', 'mixed') AND density > 0.2 AS lines FROM g")
def mode_gates(spark, sf_dir):
    p = layout.page_mode(_manifest(spark, sf_dir))
    mark = lambda df, name: df.select("doc_id", F.lit(True).alias(name))
    x = p.select("doc_id").join(mark(layout.for_native_text(p), "text"), "doc_id", "left").join(mark(layout.for_rendering(p), "image"), "doc_id", "left").join(mark(layout.for_vector_tables(p), "lines"), "doc_id", "left")
    return x.fillna(False)


def _regions(spark, sf_dir):
    i = F.col("l_orderkey")
    x = ad.table(spark, sf_dir, "lineitem").select(i.alias("img_id"), F.col("l_linenumber").cast("int").alias("region_idx"), "l_partkey", "l_suppkey")
    a, b = F.col("l_partkey"), F.col("l_suppkey")
    return x.select("img_id", "region_idx", F.when(a % 2 == 0, "table").otherwise("text").alias("type"), (a % 700 - 50 + 0.5).alias("x0"), (b % 900 - 40 + 0.5).alias("y0"), (a % 700 - 50 + b % 40 + 0.5).alias("x1"), (b % 900 - 40 + a % 50 + 0.5).alias("y1"), F.lit(595).alias("width"), F.lit(842).alias("height"))


_REGIONS = "rg AS (SELECT l_orderkey AS img_id, l_linenumber::int AS region_idx, CASE WHEN l_partkey % 2 = 0 THEN 'table' ELSE 'text' END AS type, l_partkey % 700 - 50 + 0.5::double AS x0, l_suppkey % 900 - 40 + 0.5::double AS y0, l_partkey % 700 - 50 + l_suppkey % 40 + 0.5::double AS x1, l_suppkey % 900 - 40 + l_partkey % 50 + 0.5::double AS y1 FROM lineitem)"


@query(f"WITH {_REGIONS}, c AS (SELECT img_id, region_idx, type, greatest(0, least(trunc(x0)::int, 595)) AS x0, greatest(0, least(trunc(y0)::int, 842)) AS y0, greatest(0, least(trunc(x1)::int, 595)) AS x1, greatest(0, least(trunc(y1)::int, 842)) AS y1 FROM rg) SELECT * FROM c WHERE x1 > x0 AND y1 > y0 AND (type <> 'text' OR (x1 - x0 >= 10 AND y1 - y0 >= 10))")
def region_crops(spark, sf_dir):
    return layout.crops(_regions(spark, sf_dir)).drop("width", "height")


@query(f"WITH {_REGIONS} SELECT img_id, type, y0, (row_number() OVER (PARTITION BY img_id ORDER BY y0, type <> 'table', region_idx) - 1)::int AS rank FROM rg")
def region_order(spark, sf_dir):
    return layout.region_order(_regions(spark, sf_dir), ["img_id"]).select("img_id", "type", "y0", "rank")


# ------------------------------------------------------------------ contents and sections

_T3 = [r"\.{2,}\s*([0-9]{1,3})\s*$", r"\s+([0-9]{1,3})\s*$", r"([0-9]{1,3})\s*$"]
_TARGET = "coalesce(" + ", ".join(f"CASE WHEN try_cast(nullif(regexp_extract(trim(text), '{p}', 1), '') AS int) BETWEEN 1 AND 500 THEN try_cast(nullif(regexp_extract(trim(text), '{p}', 1), '') AS int) END" for p in _T3) + ")"


@query(f"WITH {ad.TOC_LINES} SELECT seq, " + _TARGET + " AS target FROM toc")
def toc_target_page(spark, sf_dir):
    return ad.toc_lines(spark, sf_dir).select("seq", ft.toc_target_page(F.col("text")).alias("target"))


_FIN = lambda what: "CASE " + " ".join(f"WHEN contains(lower(text), '{w}') THEN '{k if what == 'type' else 'keyword:' + w}'" for k, ws in ft.FINANCIAL.items() for w in ws) + " END"


@query(f"WITH {ad.TOC_LINES} SELECT seq, {_FIN('type')} AS type, {_FIN('evidence')} AS evidence FROM toc")
def financial_type_keywords(spark, sf_dir):
    t = ft.financial_type(F.col("text"))
    return ad.toc_lines(spark, sf_dir).select("seq", t["type"].alias("type"), t["evidence"].alias("evidence"))


_PAGES = f"WITH {ad.TOC_LINES}, pt AS (SELECT page_index, count(*) AS n_items, string_agg(CASE WHEN page_index % 3 = 0 THEN text ELSE regexp_replace(text, '[.0-9]', '', 'g') END, ' ' ORDER BY seq) AS text FROM toc GROUP BY page_index), tp AS (SELECT *, contains(lower(text), 'sisällysluettelo') OR contains(lower(text), 'sisallysluettelo') OR contains(lower(text), 'contents') OR (len(regexp_extract_all(text, '[0-9]+\\.[0-9]+(\\.[0-9]+)?')) >= 3 AND len(regexp_extract_all(text, '\\.{{3,}}')) >= 2 AND len(regexp_extract_all(text, '\\b[0-9]{{1,3}}\\b')) >= 3) AS is_toc FROM pt)"


def _pages(spark, sf_dir):
    t = ad.toc_lines(spark, sf_dir)
    t = t.withColumn("text", F.when(F.col("page_index") % 3 == 0, F.col("text")).otherwise(F.regexp_replace("text", "[.0-9]", "")))
    n = t.groupBy("page_index").agg(F.count("*").alias("n_items"))
    return contents.contents_pages(quality.page_text(t, ["page_index"]).join(n, "page_index"))


@query(_PAGES + " SELECT page_index, n_items, is_toc FROM tp")
def toc_page_detect(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_index", "n_items", "is_toc")


_ENTRY = f"""WITH {ad.TOC_LINES}, k AS (SELECT page_index, seq, lower(text) AS low, text, unnest(['tuloslaskelma', 'income statement', 'rahoituslaskelma', 'cash flow', 'tase', 'balance sheet', 'liitetiedot', 'notes']) AS word,
  unnest(['income_statement', 'income_statement', 'cash_flow_statement', 'cash_flow_statement', 'balance_sheet', 'balance_sheet', 'notes', 'notes']) AS type, unnest(range(0, 8)) AS i FROM toc),
e0 AS (SELECT page_index, seq * 100 + i AS write, coalesce(nullif(regexp_extract(text, '(?i)[0-9]+\\.[0-9]+(?:\\.[0-9]+)?\\s*' || word || '[^\\n]*'), ''), word) AS entry, type, coalesce({_TARGET}, -1) AS target FROM k WHERE contains(low, word)),
en AS (SELECT page_index, entry, arg_max(type, write) AS type, arg_max(target, write) AS target, min(write) AS first FROM e0 GROUP BY ALL)"""


@query(_ENTRY + " SELECT * FROM en")
def toc_entries(spark, sf_dir):
    return contents.entries(ad.toc_lines(spark, sf_dir))


@query(_ENTRY + ", o AS (SELECT target - page_index AS off FROM en WHERE target - page_index BETWEEN 1 AND 200) SELECT (list_sort(list(off)))[count(*) // 2 + 1] AS median FROM o")
def page_offset(spark, sf_dir):
    o = contents.entries(ad.toc_lines(spark, sf_dir)).select((F.col("target") - F.col("page_index")).alias("off")).where("off between 1 and 200")
    return contents.upper_median(o, "off")


@query(_ENTRY + ", t AS (SELECT target + 2 AS p, arg_max(type, (first, page_index, entry)) AS type FROM en WHERE target >= 0 GROUP BY target) SELECT page_index, coalesce(t.type, 'none') AS section FROM (SELECT DISTINCT page_index FROM toc) x LEFT JOIN t ON x.page_index = t.p")
def toc_target_map(spark, sf_dir):
    t = ad.toc_lines(spark, sf_dir)
    return contents.targets(contents.entries(t), t.select("page_index").distinct(), 2)


@query(_ENTRY + ", m AS (SELECT t.page_index, t.seq, en.type, en.target, en.first FROM toc t JOIN en ON t.page_index = en.page_index AND contains(lower(t.text), lower(en.entry))) SELECT page_index, seq, arg_min(type, first) AS type, arg_min(target, first) AS target FROM m GROUP BY ALL")
def toc_first_match(spark, sf_dir):
    t = ad.toc_lines(spark, sf_dir)
    return contents.first_match(t, contents.entries(t))


_SECTION_RULES = [
    "regexp_matches(lower(text), 'liitetiedot|notes|liite|selitykset|explanatory notes') THEN 'notes'", "regexp_matches(lower(text), 'tase|balance sheet') THEN 'balance_sheet'", "regexp_matches(lower(text), 'tuloslaskelma|income statement') THEN 'income_statement'",
    "regexp_matches(lower(text), 'rahoituslaskelma|cash flow|rahavirtalaskelma|cash_assets') THEN 'cash_flow_statement'", "regexp_matches(lower(text), 'tilinpäätöksen laatimisperiaatteet|accounting policies|financial_statement_principles') THEN 'accounting_policies'",
]
_SECTION = _PAGES + ", se AS (SELECT page_index, n_items, CASE WHEN is_toc THEN 'toc' WHEN " + " WHEN ".join(
    ["page_index = 0 AND regexp_matches(lower(text), 'tilinpäätös|financial statement|annual report|vuosikertomus') THEN 'cover'", "regexp_matches(lower(text), 'johtajan kertomus|management report|hallituksen kertomus') THEN 'management_report'"]
    + _SECTION_RULES
    + ["page_index > n_items * 0.8 THEN 'appendix'", "page_index = 0 THEN 'cover'"]
) + " ELSE 'appendix' END AS section FROM tp)"


@query(_SECTION + " SELECT page_index, section FROM se")
def page_sections(spark, sf_dir):
    return contents.section(_pages(spark, sf_dir)).select("page_index", "section")


@query(_SECTION + ", g AS (SELECT page_index // 4 AS doc, count(*) AS pages, list(DISTINCT section) AS present FROM se GROUP BY ALL) SELECT doc, pages, missing FROM (SELECT doc, pages, present, unnest(CASE WHEN pages <= 5 THEN ['cover', 'toc'] ELSE ['income_statement', 'balance_sheet'] END) AS missing FROM g) WHERE NOT list_contains(present, missing)")
def missing_sections(spark, sf_dir):
    s = contents.section(_pages(spark, sf_dir)).withColumn("doc", F.expr("page_index div 4"))
    return qa.missing_sections(s, "doc")


@query(_PAGES + ", r AS (SELECT page_index, is_toc AS page_is_toc, page_index % 5 = 1 AS is_toc, page_index % 4 <> 2 AS valid FROM tp) SELECT page_index, CASE WHEN page_is_toc OR is_toc THEN 'list_items' WHEN NOT valid THEN 'text_block' ELSE 'table' END AS route FROM r")
def refine_routes(spark, sf_dir):
    p = F.col("page_index")
    x = _pages(spark, sf_dir).select("page_index", F.col("is_toc").alias("page_is_toc"), (p % 5 == 1).alias("is_toc"), (p % 4 != 2).alias("valid"))
    return contents.route(x).select("page_index", "route")


# ------------------------------------------------------------------ checks

_REFS = f"""WITH {ad.REFERENCES}, {ad.DEFINITIONS}, x AS (SELECT block_id, page_index, unnest(list_concat(regexp_extract_all(lower(text), 'liite\\s*([0-9]+)', 1), regexp_extract_all(lower(text), 'liitetieto\\s*([0-9]+)', 1), regexp_extract_all(lower(text), 'ks\\.\\s*liite\\s*([0-9]+)', 1), regexp_extract_all(lower(text), 'note\\s*([0-9]+)', 1), regexp_extract_all(lower(text), 'see\\s+note\\s*([0-9]+)', 1))) AS note FROM refs),
mi AS (SELECT note, count(*) AS mentions, min(block_id) AS first_block, arg_min(page_index, block_id) AS page_index FROM x ANTI JOIN defs USING (note) GROUP BY note)"""


@query(_REFS + " SELECT * FROM mi")
def missing_notes(spark, sf_dir):
    return qa.missing_notes(ad.references(spark, sf_dir), ad.definitions(spark, sf_dir))


_DIFF = f"WITH {ad.GOLDEN}, a AS (SELECT source, count(*) AS n FROM documents GROUP BY source), b AS (SELECT source, count(*) AS n FROM golden GROUP BY source), di AS (SELECT coalesce(a.source, b.source) AS source, coalesce(a.n, 0) AS n_now, coalesce(b.n, 0) AS n_before FROM a FULL JOIN b ON a.source = b.source WHERE coalesce(a.n, 0) <> coalesce(b.n, 0))"


@query(_DIFF + " SELECT * FROM di")
def golden_diff(spark, sf_dir):
    return qa.snapshot_diff(_docs(spark, sf_dir), ad.golden(spark, sf_dir), "source")


# ------------------------------------------------------------------ music

_BEATS = "CASE {0} WHEN 'whole' THEN 4.0 WHEN 'half' THEN 2.0 WHEN 'quarter' THEN 1.0 WHEN 'eighth' THEN 0.5 WHEN '16th' THEN 0.25 WHEN '32nd' THEN 0.125 WHEN '64th' THEN 0.0625 WHEN 'breve' THEN 8.0 WHEN 'long' THEN 16.0 ELSE 1.0 END::double"
_BPM = "CASE WHEN time_signature = '3/4' THEN 3.0 WHEN time_signature = '6/8' THEN 2.0 ELSE 4.0 END::double"


@query(f"WITH {ad.NOTES_CTE} SELECT piece_id, measure_seq, note_seq, coalesce(sum({_BEATS.format('duration')}) OVER (PARTITION BY piece_id, measure_seq ORDER BY note_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::double) AS beat FROM notes")
def note_beats(spark, sf_dir):
    return music.positions(ad.notes(spark, sf_dir)).select("piece_id", "measure_seq", "note_seq", "beat")


_MEASURES = f"me AS (SELECT piece_id, measure_seq, sum({_BEATS.format('duration')}) AS actual, max({_BPM}) AS expected FROM notes GROUP BY ALL), ms AS (SELECT *, CASE WHEN abs(expected - actual) < 0.1 THEN 'valid' WHEN actual > expected + 0.1 THEN 'excess' ELSE 'short' END AS state FROM me)"


@query(f"WITH {ad.NOTES_CTE}, {_MEASURES} SELECT * FROM ms")
def measure_validity(spark, sf_dir):
    return music.measures(ad.notes(spark, sf_dir))


_SNAP = "(SELECT list_sort([" + ", ".join(f"{{{{'off': abs({v}::double - {{0}}), 'i': {i}, 'b': {v}::double}}}}" for i, v in enumerate(fm.DURATIONS.values())) + "])[1].b)"


@query(f"WITH {ad.NOTES_CTE}, {_MEASURES}, fx AS (SELECT n.piece_id, n.measure_seq, n.time_signature, ms.expected, CASE WHEN state = 'excess' THEN {_SNAP.format('(' + _BEATS.format('n.duration') + ' * (ms.expected / ms.actual))')} ELSE {_BEATS.format('n.duration')} END AS b FROM notes n JOIN ms USING (piece_id, measure_seq)), am AS (SELECT piece_id, measure_seq, abs(max(expected) - sum(b)) >= 0.1 AS wrong FROM fx GROUP BY ALL), a AS (SELECT piece_id, count_if(wrong) AS still_wrong FROM am GROUP BY piece_id), b AS (SELECT piece_id, count(*) AS measures, count_if(state <> 'valid') AS wrong FROM ms GROUP BY piece_id) SELECT b.piece_id, measures, wrong, still_wrong, still_wrong = 0 AS all_valid FROM b JOIN a USING (piece_id)")
def rhythm_summary(spark, sf_dir):
    return music.rhythm_summary(ad.notes(spark, sf_dir))


@query(f"WITH {ad.NOTES_CTE}, m AS (SELECT piece_id, measure_seq, max(key_signature) AS key FROM notes GROUP BY ALL), k AS (SELECT piece_id, arg_min(key, measure_seq) FILTER (key <> 'C') AS o, arg_min(key, measure_seq) AS a FROM m WHERE key IS NOT NULL GROUP BY piece_id) SELECT m.piece_id, measure_seq, coalesce(key, o, a) AS key FROM m LEFT JOIN k USING (piece_id)")
def key_fill(spark, sf_dir):
    return music.filled_keys(ad.notes(spark, sf_dir))


@query("WITH t AS (SELECT DISTINCT lower(trim(w)) AS w FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) WHERE w <> ''), c AS (SELECT CASE WHEN w IN ('ppp','pp','p','mp','mf','f','ff','fff','sfz','sfp','fp','rf','rfz','fz') THEN 'dynamic' WHEN " + " OR ".join(f"contains(w, '{e}')" for e in fm.EXPRESSIONS) + " THEN 'expression' WHEN contains(w, '=') AND regexp_matches(w, '[0-9]') THEN 'tempo' WHEN regexp_full_match(w, '[0-9]{1,9}') AND try_cast(w AS bigint) < 500 THEN 'measure_number' ELSE 'text' END AS class FROM t) SELECT class, count(*) AS n FROM c GROUP BY class")
def music_text_class(spark, sf_dir):
    w = _docs(spark, sf_dir).select(F.explode(F.split("text", " ")).alias("w")).where("w <> ''").select(F.lower(F.trim("w")).alias("text")).distinct()
    return music.classified_tokens(w).groupBy("class").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ lines of code

_LOC = rf"""WITH {ad.SOURCE_LINES}, s0 AS (SELECT path, line_no, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t, CASE WHEN ends_with(path, '.html') THEN 'HTML' WHEN ends_with(path, '.md') THEN 'Markdown' ELSE 'Other' END AS language FROM src_lines),
s1 AS (SELECT *, CASE WHEN language = 'HTML' AND contains(t, '-->') THEN 0 WHEN language = 'HTML' AND contains(t, '<!--') THEN 1 END AS mark FROM s0),
s2 AS (SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY path ORDER BY line_no), 0) AS ins FROM s1),
s3 AS (SELECT path, language, t = '' AS blank, t <> '' AND (ins = 1 OR one) AS comment, t <> '' AND ins = 0 AND (NOT one OR trim(string_split(t, '<!--')[1]) <> '') AS code FROM (SELECT *, language = 'HTML' AND contains(t, '<!--') AND contains(t, '-->') AS one FROM s2)),
fi AS (SELECT path, language, sum(code::int)::bigint AS code, sum(comment::int)::bigint AS comments, sum(blank::int)::bigint AS blanks, count_if(NOT blank) AS non_empty, CASE WHEN language = 'Markdown' THEN 'docs' ELSE 'code' END AS category FROM s3 GROUP BY path, language HAVING count_if(NOT blank) > 0)"""


@query(_LOC + " SELECT language, category, count(*) AS files, sum(code)::bigint AS code, sum(comments)::bigint AS comments, sum(blanks)::bigint AS blanks, sum(non_empty)::bigint AS non_empty FROM fi GROUP BY ALL HAVING sum(code) > 0")
def loc_by_language(spark, sf_dir):
    return loc.by_language(ad.source_lines(spark, sf_dir))


@query(_LOC + " SELECT * FROM fi ORDER BY code + comments DESC, path LIMIT 20")
def loc_topk_filled(spark, sf_dir):
    return loc.top_files(ad.source_lines(spark, sf_dir), by="filled")


@query(_LOC + " SELECT * FROM fi ORDER BY code DESC, path LIMIT 20")
def loc_topk(spark, sf_dir):
    return loc.top_files(ad.source_lines(spark, sf_dir))


# ------------------------------------------------------------------ elements and sheets

_FONTS = ("Arial-Bold", "Arial-Black", "Arial-Italic", "Arial")


def _fonts(spark, sf_dir):
    b = ad.blocks(spark, sf_dir)
    k = F.col("doc_id") + F.col("seq")
    font = F.element_at(F.array(*[F.lit(f) for f in _FONTS]), (k % 4 + 1).cast("int"))
    mark = F.element_at(F.array(*[F.lit(m) for m in ("• ", "- ", "1. ", "", "7 ")]), (k % 5 + 1).cast("int"))
    return b.select("doc_id", "page_index", "seq", font.alias("font"), (k % 6 + 9).cast("double").alias("size"), F.concat(mark, F.col("text")).alias("text"))


_FONTS_SQL = f"{ad.BLOCKS}, fo AS (SELECT doc_id, page_index, seq, ['Arial-Bold', 'Arial-Black', 'Arial-Italic', 'Arial'][(doc_id + seq) % 4 + 1] AS font, ((doc_id + seq) % 6 + 9)::double AS size, ['• ', '- ', '1. ', '', '7 '][(doc_id + seq) % 5 + 1] || text AS text FROM blocks)"


@query(f"WITH {_FONTS_SQL} SELECT doc_id, seq, font IN ('Arial-Bold', 'Arial-Black') AS bold, font = 'Arial-Italic' AS italic, CASE WHEN size > 12 AND length(text) < 100 THEN 'title' WHEN regexp_matches(trim(text), '^(•|-|1\\.|2\\.|3\\.)') THEN 'list_item' ELSE 'text' END AS kind FROM fo")
def block_kinds(spark, sf_dir):

    return elements.block_kinds(_fonts(spark, sf_dir)).select("doc_id", "seq", "bold", "italic", "kind")


_TYPED = f"WITH {ad.TOC_LINES}, ty AS (SELECT page_index, seq, CASE WHEN seq % 11 = 0 THEN 'table' ELSE 'block' END AS kind, CASE WHEN seq % 13 = 0 THEN 'list_item' END AS semantic_type, seq % 20 = 0 AS is_first, seq % 2 = 0 AS bold, CASE seq % 3 WHEN 0 THEN '- ' ELSE '' END || CASE WHEN seq % 4 = 0 THEN repeat(text || ' ', 4) ELSE text END AS text FROM toc)"


@query(_TYPED + r" SELECT seq, CASE WHEN kind = 'table' THEN 'table' WHEN semantic_type IS NOT NULL THEN semantic_type WHEN is_first AND length(trim(lower(text))) < 100 AND len(list_filter(regexp_split_to_array(trim(lower(text)), '\s+'), lambda w: w <> '')) <= 5 THEN 'title' WHEN length(trim(lower(text))) < 50 AND bold AND regexp_matches(lower(text), 'tase|tuloslaskelma|liite|notes') THEN 'section_header' WHEN regexp_matches(trim(lower(text)), '^[0-9•*-]\s+') THEN 'list_item' ELSE 'text' END AS semantic_type FROM ty")
def element_types(spark, sf_dir):

    s = F.col("seq")
    t = ad.toc_lines(spark, sf_dir).select("page_index", "seq", F.when(s % 11 == 0, "table").otherwise("block").alias("kind"), F.when(s % 13 == 0, "list_item").alias("semantic_type"), (s % 20 == 0).alias("is_first"), (s % 2 == 0).alias("bold"), F.concat(F.when(s % 3 == 0, "- ").otherwise(""), F.when(s % 4 == 0, F.repeat(F.concat("text", F.lit(" ")), F.lit(4))).otherwise(F.col("text"))).alias("text"))
    return elements.semantic_types(t).select("seq", "semantic_type")


_PHRASES = ("Vastaavaa", "VASTATTAVAA", "Pysyvät vastaavat", "Oma pääoma", "Toimintatuotot", "Vuosikate", "TILIKAUDEN TULOS", "Toiminnan rahavirta", "Rahavarojen muutos", "Liite ", "x", "y")
_PHRASES_SQL = "[" + ", ".join(f"'{p}'" for p in _PHRASES) + "]"
_HARD = f"WITH ph AS (SELECT o_orderkey // 3 AS page, string_agg({_PHRASES_SQL}[(o_custkey % 12 + 1)::int], ' ' ORDER BY o_orderkey) || repeat('.', (o_orderkey // 3 % 2 * 600)::int) AS text FROM orders GROUP BY o_orderkey // 3)"


@query(_HARD + ", h AS (SELECT page, text, " + ", ".join(f"{' + '.join(f'''contains(lower(text), '{p}')::int''' for p in ps)} AS {k}" for k, ps in elements.INDICATORS.items()) + " FROM ph) SELECT page, CASE WHEN balance_sheet >= 2 THEN 'balance_sheet' WHEN income_statement >= 2 THEN 'income_statement' WHEN cash_flow_statement >= 2 THEN 'cash_flow_statement' WHEN contains(lower(text), 'liite ') AND length(text) > 500 THEN 'notes' END AS section FROM h")
def hard_rules(spark, sf_dir):

    phrase = F.element_at(F.array(*[F.lit(p) for p in _PHRASES]), (F.col("o_custkey") % 12 + 1).cast("int"))
    o = ad.table(spark, sf_dir, "orders").select(F.expr("o_orderkey div 3").alias("page"), F.col("o_orderkey").alias("seq"), phrase.alias("text"))
    p = quality.page_text(o, ["page"]).withColumn("text", F.concat("text", F.repeat(F.lit("."), (F.col("page") % 2 * 600).cast("int"))))
    return elements.indicated(p).select("page", "section")


_TOKENS = ("ff", "mf", "cresc", "dolce", "q=96", "123", "Andante", "© 1999", "ab", "Kai Niemiselle", "p", "501")
_TOKENS_SQL = "tk AS (SELECT user_id AS piece_id, event_id AS seq, ['header', 'footer', 'between_staff_1'][(event_id % 3 + 1)::int] AS region, [" + ", ".join(f"'{t}'" for t in _TOKENS) + "][(event_id % 12 + 1)::int] AS text, (event_id * 7 % 11) / 10::double AS confidence FROM events)"


def _tokens(spark, sf_dir):
    e = F.col("event_id")
    pick = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))
    return ad.table(spark, sf_dir, "events").select(F.col("user_id").alias("piece_id"), e.alias("seq"), pick(("header", "footer", "between_staff_1"), e % 3).alias("region"), pick(_TOKENS, e % 12).alias("text"), (e * 7 % 11 / 10).alias("confidence"))


@query(f"WITH {_TOKENS_SQL} SELECT seq, CASE WHEN confidence < 0.55 THEN false WHEN text = 'ff' THEN false WHEN text = 'ab' THEN false WHEN region = 'header' AND length(text) >= 3 AND confidence >= 0.7 THEN true WHEN region = 'between_staff_1' THEN text IN ('mf', 'cresc', 'dolce', '123', 'Andante', 'p') OR (confidence >= 0.8 AND length(text) >= 4) WHEN region = 'footer' THEN contains(text, '©') OR text IN ('123', '501') OR confidence >= 0.7 ELSE true END AS valid FROM tk")
def music_tokens(spark, sf_dir):

    return sheet.valid_tokens(_tokens(spark, sf_dir)).select("seq", "valid")


@query(f"WITH {_TOKENS_SQL} SELECT piece_id, coalesce(string_agg(DISTINCT text, ',' ORDER BY text) FILTER (text IN ('ff', 'mf', 'p')), '') AS dynamics, coalesce(string_agg(DISTINCT text, ',' ORDER BY text) FILTER (text IN ('cresc', 'dolce')), '') AS expressions, max(text) FILTER (text = 'q=96') AS tempo, max(CASE WHEN text = '123' THEN 123 END)::int AS measure_count, max(text) FILTER (text = '© 1999' AND region = 'footer') AS copyright FROM tk GROUP BY piece_id")
def music_metadata(spark, sf_dir):

    return sheet.metadata(_tokens(spark, sf_dir))


@query(ORACLES["rhythm_summary"].replace("SELECT b.piece_id, measures, wrong, still_wrong, still_wrong = 0 AS all_valid FROM b JOIN a USING (piece_id)", "SELECT piece_id, unnest(list_concat(CASE WHEN piece_id % 3 = 0 THEN ['metadata_title'] ELSE [] END, ['metadata_composer'], CASE WHEN piece_id % 4 = 0 THEN ['staff_detection'] ELSE [] END, CASE WHEN still_wrong > 0 THEN ['rhythm_validation'] ELSE [] END, CASE WHEN piece_id % 5 = 0 THEN ['time_signature_coverage'] ELSE [] END)) AS check FROM b JOIN a USING (piece_id)").replace("AS check", "AS \"check\""))
def music_checks(spark, sf_dir):

    r = music.rhythm_summary(ad.notes(spark, sf_dir))
    p = r.select("piece_id", F.when(F.col("piece_id") % 3 != 0, "t").alias("title"), F.lit(None).cast("string").alias("composer"), F.lit(True).alias("omr_success"), F.lit("score").alias("omr_engine"), (F.col("piece_id") % 4).alias("staff_count"), F.col("measures").alias("measure_count"), "still_wrong", F.when(F.col("piece_id") % 5 == 0, F.col("measures")).otherwise(0).alias("without_time"), F.lit(0).alias("without_beat"))
    return sheet.checks(p).select("piece_id", "check")


@query("SELECT source, count(*) AS documents, count(DISTINCT lang) AS langs, array_to_string(list_sort(list(DISTINCT lang)), ',') AS present FROM documents GROUP BY source")
def distinct_sets(spark, sf_dir):
    return _docs(spark, sf_dir).groupBy("source").agg(F.count("*").alias("documents"), F.count_distinct("lang").alias("langs"), F.concat_ws(",", F.array_sort(F.collect_set("lang"))).alias("present"))


_NAMES = ("main.py", "x.min.js", "style.css.map", "package-lock.json", "Yarn.lock", "pnpm-lock.yaml", "poetry.lock", "Pipfile.lock", "a.JS", "b.tsx", "c.cxx", "d.h", "e.bash", "f.htm", "Makefile", "minute.py", "map.md", "g.yml", "h.sql", "i.rs", "j.unknown", "k.c", "l.cc", "m.hpp", "n.kt", "o.toml", "p.json", "q.xml", "r.ps1")
_FOLDERS = (*loc.EXCLUDED_DIRS, "", "vendor", "env", ".hg", "coverage2", "src/building")
_FILES = _NAMES + tuple(f"z{s}" for s in loc.BINARY)
_LANGUAGES_SQL = "CASE " + " ".join(f"WHEN lower(suffix) = '{e}' THEN '{lang}'" for e, lang in ((".py", "Python"), (".js", "JavaScript"), (".tsx", "TypeScript"), (".cxx", "C++"), (".h", "C"), (".bash", "Shell"), (".htm", "HTML"), (".md", "Markdown"), (".yml", "YAML"), (".sql", "SQL"), (".rs", "Rust"), (".c", "C"), (".cc", "C++"), (".hpp", "C++"), (".kt", "Kotlin"), (".toml", "TOML"), (".json", "JSON"), (".xml", "XML"), (".ps1", "PowerShell"))) + " ELSE 'Other' END"
_PATHS = f"""WITH p AS (SELECT 'r/' || source || '/' || {ad._strings(_FOLDERS)}[(doc_id % {len(_FOLDERS)} + 1)::int] || '/d' || doc_id || '/' || {ad._strings(_FILES)}[(doc_id // {len(_FOLDERS)} % {len(_FILES)} + 1)::int] AS path FROM documents),
q AS (SELECT path, regexp_extract(path, '[^/](\\.[^./]+)$', 1) AS suffix FROM p)
SELECT {_LANGUAGES_SQL} AS language, count(*) AS files FROM q
WHERE NOT list_has_any(string_split(path, '/'), ['node_modules', 'dist', 'build', '.next', '.nuxt', '.cache', '.venv', 'venv', '__pycache__', '.git', 'coverage', 'target', 'out', '.turbo', '.idea', '.vscode', '.pytest_cache'])
  AND lower(suffix) NOT IN ('.pdf', '.png', '.jpg', '.jpeg', '.gif', '.bmp', '.ico', '.svg', '.zip', '.tar', '.gz', '.7z', '.rar', '.exe', '.dll', '.so', '.dylib', '.pyc', '.pyo', '.pyd', '.db', '.sqlite', '.sqlite3', '.xlsx', '.xls', '.doc', '.docx', '.mxl', '.omr')
  AND NOT regexp_matches(path, '(?i)\\.min\\.|\\.map$|package-lock\\.json$|yarn\\.lock$|pnpm-lock\\.yaml$|poetry\\.lock$|pipfile\\.lock$') GROUP BY ALL"""


@query(_PATHS)
def path_filter(spark, sf_dir):
    i = F.col("doc_id")
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))
    p = _docs(spark, sf_dir).select(F.concat(F.lit("r/"), "source", F.lit("/"), pick(_FOLDERS, i), F.lit("/d"), i.cast("string"), F.lit("/"), pick(_FILES, F.expr(f"doc_id div {len(_FOLDERS)}"))).alias("path"))
    return loc.without_excluded(p).select(loc.language(F.col("path")).alias("language")).groupBy("language").agg(F.count("*").alias("files"))
