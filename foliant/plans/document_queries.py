"""Registered queries over whole documents: classification, checks and reports, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.functions.text import FINANCIAL
from foliant.operators import checkers, document, music, quality, sheet
from foliant.plans import queries as q
from foliant.plans.queries import query
from foliant.sources import adapters as ad
from foliant.sources.scratch import release, saved


def _report(spark, sf_dir):
    """documents, pages (with quality), items and cells of the reports, each written once."""
    pages = saved(ad.report_pages(spark, sf_dir), "report-pages")
    items, cells = saved(ad.report_items(pages), "report-items"), saved(ad.report_cells(spark, sf_dir, pages), "report-cells")
    texts = quality.page_text(items.where("kind = 'block'"), document.PAGE)
    documents = pages.select("doc_id").distinct().withColumn("pdf", F.when(F.col("doc_id") % 41 != 0, F.concat(F.lit("r"), F.col("doc_id").cast("string"), F.lit(".pdf"))))
    lost = documents.select((F.col("doc_id") + 10_000_000).alias("doc_id"), "pdf").where("doc_id % 50 = 7")
    return documents.unionByName(lost), saved(document.with_quality(pages, texts), "report-quality"), items, cells


def _typed(spark, sf_dir):
    documents, pages, items, cells = _report(spark, sf_dir)
    texts = saved(document.item_texts(items, cells), "item-texts")
    sections = saved(document.classified_pages(documents, pages, items, cells, texts), "sections")
    typed = saved(document.classified_items(items, cells, sections, texts), "items")
    release(texts)
    return documents, pages, items, cells, sections, typed


# ------------------------------------------------------------------ classification

_HAS = lambda col, words: f"regexp_matches({col}, '{'|'.join(words)}')"
_PARTS = f"""{ad.REPORT},
ct AS (SELECT doc_id, page_index, seq, string_agg(text_raw, ' ' ORDER BY cell_seq) AS cfull, array_to_string((list(text_raw ORDER BY cell_seq) FILTER (row_idx = 0))[:5], ' ') AS head, array_to_string((list(lower(text_raw) ORDER BY cell_seq))[:10], ' ') AS ten,
  count(*) >= 3 AND ((count_if(regexp_matches(text_raw, '\\.{{2,}}'))::double / count(*) > 0.1 AND count_if(regexp_full_match(trim(text_raw), '[0-9]{{1,3}}'))::double / count(*) > 0.1) OR count_if(regexp_matches(text_raw, '\\.{{2,}}'))::double / count(*) > 0.2) AS toc_table FROM rc GROUP BY ALL),
tx AS (SELECT i.*, coalesce(cfull, i.text, '') AS fullt, coalesce(head, i.text, '') AS sample, coalesce(toc_table, false) AS toc_table, ten, row_number() OVER (PARTITION BY i.doc_id, i.page_index ORDER BY i.seq) AS n FROM ri i LEFT JOIN ct ON i.doc_id = ct.doc_id AND i.page_index = ct.page_index AND i.seq = ct.seq),
pg AS (SELECT doc_id, page_index, count(*) AS n_items, ' ' || string_agg(fullt, ' ' ORDER BY seq) AS fullt, lower(string_agg(sample, ' ' ORDER BY seq) FILTER (n <= 10)) AS s, bool_or(toc_table) AS tt,
  bool_or(coalesce(semantic_type = 'list_item', false) OR (n <= 10 AND contains(sample, '...'))) AS listed FROM tx GROUP BY ALL),
s0 AS (SELECT *, {_HAS('lower(fullt)', ('sisällysluettelo', 'sisallysluettelo', 'contents'))} OR (len(regexp_extract_all(fullt, '[0-9]+\\.[0-9]+(?:\\.[0-9]+)?')) >= 3 AND len(regexp_extract_all(fullt, '\\.{{3,}}')) >= 2 AND len(regexp_extract_all(fullt, '\\b[0-9]{{1,3}}\\b')) >= 3) OR tt AS is_toc FROM pg),
s1 AS (SELECT doc_id, page_index, n_items, fullt, CASE WHEN is_toc THEN {{'s': 'toc', 'c': 0.9::double}} WHEN page_index = 0 AND {_HAS('s', ('tilinpäätös', 'financial statement', 'annual report', 'vuosikertomus'))} THEN {{'s': 'cover', 'c': 0.9::double}}
  WHEN {_HAS('s', ('sisällysluettelo', 'contents', 'sisällys'))} AND listed THEN {{'s': 'toc', 'c': 0.85::double}} WHEN {_HAS('s', ('johtajan kertomus', 'management report', 'hallituksen kertomus'))} THEN {{'s': 'management_report', 'c': 0.8::double}}
  WHEN {_HAS('s', FINANCIAL['notes'])} THEN {{'s': 'notes', 'c': 0.8::double}} WHEN {_HAS('s', ('tase', 'balance sheet'))} THEN {{'s': 'balance_sheet', 'c': 0.7::double}} WHEN {_HAS('s', ('tuloslaskelma', 'income statement'))} THEN {{'s': 'income_statement', 'c': 0.7::double}}
  WHEN {_HAS('s', FINANCIAL['cash_flow_statement'])} THEN {{'s': 'cash_flow_statement', 'c': 0.7::double}} WHEN {_HAS('s', FINANCIAL['accounting_policies'])} THEN {{'s': 'accounting_policies', 'c': 0.7::double}}
  WHEN page_index > n_items * 0.8::double THEN {{'s': 'appendix', 'c': 0.3::double}} WHEN page_index = 0 THEN {{'s': 'cover', 'c': 0.5::double}} ELSE {{'s': 'appendix', 'c': 0.1::double}} END AS x FROM s0),
oc AS (SELECT doc_id, page_index - t::int AS off FROM (SELECT ri.doc_id, ri.page_index, trim(text) AS t FROM ri JOIN rp USING (doc_id, page_index) WHERE kind = 'block' AND page_index BETWEEN 3 AND 14 AND (ri.y0 > height * 0.85::double OR ri.y1 > height * 0.85::double)) WHERE regexp_full_match(t, '[0-9]{{1,3}}') AND t::int BETWEEN 1 AND 200),
of AS (SELECT d.doc_id, coalesce(o.m, t.m, 2)::int AS off FROM (SELECT DISTINCT doc_id FROM rp) d LEFT JOIN (SELECT doc_id, list_sort(list(off))[count(*) // 2 + 1] AS m FROM oc GROUP BY doc_id) o USING (doc_id)
       LEFT JOIN (SELECT doc_id, min(page_index) - 1 AS m FROM s1 WHERE x.s = 'toc' GROUP BY doc_id) t USING (doc_id))"""
_TARGET = q._TARGET
_ENTRIES = f"""tl AS (SELECT doc_id, page_index, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY seq, c) AS seq, text FROM (SELECT doc_id, page_index, seq, 0 AS c, text FROM ri WHERE kind = 'block' UNION ALL SELECT doc_id, page_index, seq, cell_seq, text_raw FROM rc) SEMI JOIN {{0}} USING (doc_id, page_index)),
tk AS (SELECT doc_id, page_index, seq, text, unnest(['tuloslaskelma', 'income statement', 'rahoituslaskelma', 'cash flow', 'tase', 'balance sheet', 'liitetiedot', 'notes']) AS word,
  unnest(['income_statement', 'income_statement', 'cash_flow_statement', 'cash_flow_statement', 'balance_sheet', 'balance_sheet', 'notes', 'notes']) AS type, unnest(range(0, 8)) AS i FROM tl),
te AS (SELECT doc_id, page_index, seq * 100 + i AS w, coalesce(nullif(regexp_extract(text, '(?i)[0-9]+\\.[0-9]+(?:\\.[0-9]+)?\\s*' || word || '[^\\n]*'), ''), word) AS entry, type, coalesce({_TARGET}, -1) AS target FROM tk WHERE contains(lower(text), word)),
en AS (SELECT doc_id, page_index, entry, arg_max(type, w) AS type, arg_max(target, w) AS target, min(w) AS first FROM te GROUP BY ALL)"""
_SECTIONS = f"""{_PARTS},
tp AS (SELECT doc_id, page_index FROM s1 WHERE x.s = 'toc'),
{_ENTRIES.replace("{0}", "tp")},
tg AS (SELECT doc_id, target + off AS page_index, arg_max(type, (page_index, first)) AS target FROM en JOIN of USING (doc_id) WHERE target >= 0 AND target + off >= 0 GROUP BY ALL),
hi AS (SELECT doc_id, page_index, lower(fullt) AS l, length(fullt) AS n FROM s1),
hr AS (SELECT doc_id, page_index, CASE WHEN {' + '.join(f"contains(l, '{p}')::int" for p in ('vastaavaa', 'vastattavaa', 'pysyvät vastaavat', 'vaihtuvat vastaavat', 'oma pääoma', 'vieras pääoma'))} >= 2 THEN 'balance_sheet'
  WHEN {' + '.join(f"contains(l, '{p}')::int" for p in ('toimintatuotot', 'toimintakulut', 'vuosikate', 'tilikauden tulos', 'satunnaiset tuotot', 'satunnaiset kulut'))} >= 2 THEN 'income_statement'
  WHEN {' + '.join(f"contains(l, '{p}')::int" for p in ('toiminnan rahavirta', 'investointien rahavirta', 'rahoituksen rahavirta', 'rahavarojen muutos'))} >= 2 THEN 'cash_flow_statement'
  WHEN (contains(l, 'liitetiedot') OR contains(l, 'liite ')) AND n > 500 THEN 'notes' END AS hard FROM hi),
sc AS (SELECT s1.doc_id, s1.page_index, CASE WHEN x.s IN ('toc', 'cover') THEN x.s ELSE coalesce(target, hard, x.s) END AS section,
  CASE WHEN x.s IN ('toc', 'cover') THEN x.c WHEN target IS NOT NULL THEN 0.85::double WHEN hard IS NOT NULL THEN CASE hard WHEN 'notes' THEN 0.7::double ELSE 0.9::double END ELSE x.c END AS confidence, off AS "offset"
  FROM s1 JOIN hr USING (doc_id, page_index) LEFT JOIN tg USING (doc_id, page_index) JOIN of USING (doc_id))"""


@query(f"WITH {_SECTIONS} SELECT * FROM sc")
def document_sections(spark, sf_dir):
    return document.classified_pages(*_report(spark, sf_dir))


_FT = lambda col, what: "CASE " + " ".join(f"WHEN contains({col}, '{w}') THEN '{k if what == 'type' else 'keyword:' + w}'" for k, ws in FINANCIAL.items() for w in ws) + " END"
_ITEMS = f"""{_SECTIONS},
hm AS (SELECT t.doc_id, t.page_index, t.seq, arg_min({{'t': en.type, 'p': en.target, 'e': en.entry}}, en.first) AS h FROM ri t JOIN en ON t.doc_id = en.doc_id AND t.page_index = en.page_index AND contains(lower(t.text), lower(en.entry)) WHERE t.kind = 'block' GROUP BY ALL),
it AS (SELECT tx.doc_id, tx.page_index, tx.seq, tx.kind, CASE WHEN tx.kind = 'table' THEN 'table' WHEN semantic_type IS NOT NULL THEN semantic_type
    WHEN tx.n = 1 AND length(trim(text)) < 100 AND len(list_filter(regexp_split_to_array(trim(lower(text)), '\\s+'), lambda w: w <> '')) <= 5 THEN 'title' WHEN length(trim(text)) < 50 AND bold AND regexp_matches(lower(text), 'tase|tuloslaskelma|liite|notes') THEN 'section_header'
    WHEN regexp_matches(trim(lower(text)), '^[0-9•*-]\\s+') THEN 'list_item' ELSE 'text' END AS semantic_type,
  CASE WHEN tx.kind = 'table' THEN CASE WHEN regexp_matches(ten, 'vastaavaa|vastattavaa|varat|velat') THEN {{'t': 'balance_sheet', 'e': 'structure:balance_sheet'}} WHEN regexp_matches(ten, '2023|2024') AND regexp_matches(ten, 'tuotot|kulut|tulos') THEN {{'t': 'income_statement', 'e': 'structure:income_statement'}} ELSE {{'t': {_FT('lower(sample)', 'type')}, 'e': {_FT('lower(sample)', 'e')}}} END
    WHEN h IS NOT NULL THEN {{'t': h.t, 'e': 'toc_entry:' || h.e}} ELSE {{'t': {_FT('lower(text)', 'type')}, 'e': {_FT('lower(text)', 'e')}}} END AS w, CASE WHEN h.p >= 0 THEN h.p END AS toc_target_page, "offset" AS off
  FROM tx LEFT JOIN hm USING (doc_id, page_index, seq) JOIN sc USING (doc_id, page_index)),
ty AS (SELECT doc_id, page_index, seq, kind, semantic_type, w.t AS financial_type, w.e AS evidence, toc_target_page, CASE WHEN toc_target_page + off >= 0 THEN toc_target_page + off END AS pdf_target_page FROM it)"""
# the entries of items are those of pages that are contents pages in the end
_ITEMS = _ITEMS.replace("hm AS (SELECT t.doc_id", "hp AS (SELECT doc_id, page_index FROM sc WHERE section = 'toc'),\nhm AS (SELECT t.doc_id").replace("contains(lower(t.text), lower(en.entry)) WHERE t.kind = 'block'", "contains(lower(t.text), lower(en.entry)) SEMI JOIN hp ON t.doc_id = hp.doc_id AND t.page_index = hp.page_index WHERE t.kind = 'block'")


@query(f"WITH {_ITEMS} SELECT * FROM ty")
def document_items(spark, sf_dir):
    return _typed(spark, sf_dir)[-1]


@query(f"WITH {_ITEMS} SELECT doc_id, count(*) AS items, count(toc_target_page) AS with_target, count(pdf_target_page) AS with_pdf_target, count(financial_type) AS with_type FROM ty GROUP BY doc_id")
def target_coverage(spark, sf_dir):
    return document.target_coverage(_typed(spark, sf_dir)[-1])


# ------------------------------------------------------------------ checks

_QUALITY = "q_in AS (SELECT doc_id || '/' || page_index AS id, string_agg(text, ' ' ORDER BY seq) AS text FROM ri WHERE kind = 'block' GROUP BY doc_id, page_index),\n" + q.Q_SQL
_NUM = f"nu AS (SELECT *, {q._NUM.format('text_raw')} AS v FROM (SELECT *, {q._Z.format('text_raw')} AS z FROM rc))"
_CHECKED = f"""{_ITEMS},
{_QUALITY},
pq AS (SELECT rp.*, status, score, repeat_run_max FROM rp JOIN q ON q.id = doc_id || '/' || page_index),
{_NUM},
rw AS (SELECT doc_id, page_index, seq, row_idx, max(CASE WHEN col_idx = 0 THEN lower(text_raw) END) AS label, list(v ORDER BY cell_seq) FILTER (col_idx > 0 AND v IS NOT NULL) AS v FROM nu GROUP BY ALL),
ba AS (SELECT doc_id, page_index, seq, arg_max(v[-1], row_idx) FILTER (regexp_matches(label, 'vastaavaa yhteensä|vastaavaa yht|total assets|assets total|yhteensä vastaavaa') AND len(v) > 0) AS assets,
         arg_max(v[-1], row_idx) FILTER (regexp_matches(label, 'vastattavaa yhteensä|vastattavaa yht|total liabilities|liabilities total|yhteensä vastattavaa') AND len(v) > 0) AS liabilities FROM rw GROUP BY ALL),
docs AS (SELECT DISTINCT doc_id, CASE WHEN doc_id % 41 <> 0 THEN 'r' || doc_id || '.pdf' END AS pdf FROM rp),
dl AS (SELECT * FROM docs UNION ALL SELECT doc_id + 10000000, pdf FROM docs WHERE (doc_id + 10000000) % 50 = 7),
op AS (SELECT doc_id, page_index, CASE WHEN k % 31 = 0 THEN 'good' ELSE status END AS status FROM pq WHERE k % 13 <> 0 AND doc_id % 5 <> 0),
oi AS (SELECT ty.doc_id, ty.page_index, ty.seq, CASE WHEN k % 37 = 0 THEN 'notes' ELSE financial_type END AS financial_type FROM ty JOIN rp USING (doc_id, page_index) WHERE k % 13 <> 0 AND doc_id % 5 <> 0 AND NOT (k % 29 = 0 AND seq = 2)),
bd AS (SELECT DISTINCT doc_id FROM op),
bk AS (SELECT ri.doc_id, ri.page_index, ri.seq, coalesce(text, '') AS text, section FROM ri JOIN sc USING (doc_id, page_index) WHERE kind = 'block'),
df AS (SELECT DISTINCT doc_id, unnest(list_concat(regexp_extract_all(lower(text), '^([0-9]+)\\.', 1), regexp_extract_all(lower(text), 'liite\\s*([0-9]+)', 1), regexp_extract_all(lower(text), 'liitetieto\\s*([0-9]+)', 1), regexp_extract_all(lower(text), 'note\\s*([0-9]+)', 1)))::int AS note FROM bk WHERE section = 'notes'),
rx AS (SELECT doc_id, page_index, seq, unnest(list_concat(regexp_extract_all(lower(text), 'liite\\s*([0-9]+)', 1), regexp_extract_all(lower(text), 'liitetieto\\s*([0-9]+)', 1), regexp_extract_all(lower(text), 'ks\\.\\s*liite\\s*([0-9]+)', 1), regexp_extract_all(lower(text), 'note\\s*([0-9]+)', 1), regexp_extract_all(lower(text), 'see\\s+note\\s*([0-9]+)', 1)))::int AS note
       FROM bk WHERE section IS NULL OR section <> 'notes'),
rg AS (SELECT rx.doc_id, rx.note, count(*) AS n, arg_min(rx.page_index, (rx.page_index, rx.seq)) AS page_index, any_value(df.note) IS NOT NULL AS known FROM (FROM rx SEMI JOIN (SELECT DISTINCT doc_id FROM df) USING (doc_id)) rx LEFT JOIN df ON df.doc_id = rx.doc_id AND df.note = rx.note GROUP BY ALL),
cn AS (SELECT doc_id, page_index, count(ty.seq) AS n FROM rp LEFT JOIN ty USING (doc_id, page_index) SEMI JOIN bd USING (doc_id) GROUP BY ALL),
co AS (SELECT op.doc_id, op.page_index, count(oi.seq) AS n FROM op LEFT JOIN oi USING (doc_id, page_index) GROUP BY ALL),
di AS (SELECT doc_id, page_index, coalesce(cn.n, 0) AS a, coalesce(co.n, 0) AS b FROM cn FULL JOIN co USING (doc_id, page_index) WHERE coalesce(cn.n, 0) <> coalesce(co.n, 0)),
dg AS (SELECT doc_id, list('p' || page_index || ':' || a || '>' || b ORDER BY page_index) AS l, min(page_index) AS page_index FROM di GROUP BY doc_id),
ta AS (SELECT doc_id, financial_type AS kind, count(*) AS n FROM ty SEMI JOIN bd USING (doc_id) WHERE financial_type IS NOT NULL GROUP BY ALL), tb AS (SELECT doc_id, financial_type AS kind, count(*) AS n FROM oi WHERE financial_type IS NOT NULL GROUP BY ALL),
qa AS (SELECT doc_id, coalesce(status, 'unknown') AS kind, count(*) AS n FROM pq SEMI JOIN bd USING (doc_id) GROUP BY ALL), qb AS (SELECT doc_id, coalesce(status, 'unknown') AS kind, count(*) AS n FROM op GROUP BY ALL),
mi AS (SELECT doc_id, unnest(CASE WHEN count(*) <= 5 THEN ['cover', 'toc'] ELSE ['income_statement', 'balance_sheet'] END) AS m, list(DISTINCT section) AS p FROM sc GROUP BY doc_id),
fi AS (
  SELECT doc_id, 'schema' AS checker, 0 AS page_index, NULL::varchar AS item, 'error' AS severity, 'no PDF metadata' AS reason FROM dl WHERE pdf IS NULL
  UNION ALL SELECT doc_id, 'schema', 0, NULL, 'error', 'no pages' FROM dl ANTI JOIN rp USING (doc_id)
  UNION ALL SELECT doc_id, 'schema', page_index, NULL, 'error', 'page without extent' FROM rp WHERE width <= 0 OR height <= 0
  UNION ALL SELECT doc_id, 'sums', page_index, seq::varchar, 'warning', 'row ' || row_idx || ' does not add up' FROM rw WHERE regexp_matches(label, 'yhteensä|total|sum|kokonaismäärä') AND len(v) >= 2 AND abs({q._TOTALS} - v[-1]) > 0.01::double
  UNION ALL SELECT doc_id, 'sections', 0, NULL, 'warning', 'missing: ' || string_agg(m, ', ' ORDER BY m) FROM mi WHERE NOT list_contains(p, m) GROUP BY doc_id
  UNION ALL SELECT doc_id, 'quality', (list(page_index ORDER BY score, page_index))[1], NULL, 'warning', count(*) || ' bad pages, worst: ' || array_to_string((list(page_index ORDER BY score, page_index))[:5], ', ') FROM pq WHERE status = 'bad' GROUP BY doc_id
  UNION ALL SELECT doc_id, 'quality', min(page_index), NULL, 'warning', count(*) || ' noisy pages: ' || array_to_string((list(page_index ORDER BY page_index))[:5], ', ') FROM pq WHERE repeat_run_max >= 10 GROUP BY doc_id
  UNION ALL SELECT doc_id, 'balance', page_index, seq::varchar, severity, 'assets and liabilities differ' FROM (SELECT ba.*, {q._BALANCE} FROM ba JOIN ty USING (doc_id, page_index, seq) WHERE financial_type = 'balance_sheet' AND assets IS NOT NULL AND liabilities IS NOT NULL) WHERE severity <> 'ok'
  UNION ALL SELECT doc_id, 'references', page_index, note::varchar, 'warning', 'note is missing, mentions: ' || n FROM rg WHERE NOT known
  UNION ALL SELECT doc_id, 'references', 0, NULL, 'info', count_if(known) || ' of ' || count(*) || ' notes found' FROM rg GROUP BY doc_id
  UNION ALL SELECT doc_id, 'references', 0, NULL, 'info', 'no notes, not checked' FROM (SELECT DISTINCT doc_id FROM sc) ANTI JOIN df USING (doc_id)
  UNION ALL SELECT doc_id, 'snapshot', page_index, NULL, 'warning', 'items changed on ' || len(l) || ' pages: ' || array_to_string(l[:5], ', ') FROM dg
  UNION ALL SELECT DISTINCT doc_id, 'snapshot', 0, NULL, 'warning', 'financial types changed' FROM ta FULL JOIN tb USING (doc_id, kind) WHERE ta.n IS DISTINCT FROM tb.n
  UNION ALL SELECT DISTINCT doc_id, 'snapshot', 0, NULL, 'info', 'page quality changed' FROM qa FULL JOIN qb USING (doc_id, kind) WHERE qa.n IS DISTINCT FROM qb.n
  UNION ALL SELECT doc_id, 'snapshot', 0, NULL, 'info', a || ' pages, before ' || b || '; changed ' || coalesce(len(l), 0) FROM (SELECT doc_id, count(*) AS a FROM rp SEMI JOIN bd USING (doc_id) GROUP BY doc_id) JOIN (SELECT doc_id, count(*) AS b FROM op GROUP BY doc_id) USING (doc_id) LEFT JOIN dg USING (doc_id)
  UNION ALL SELECT doc_id, 'snapshot', 0, NULL, 'info', 'no snapshot, not checked' FROM (SELECT DISTINCT doc_id FROM rp) ANTI JOIN bd USING (doc_id))"""


def _checked(spark, sf_dir):
    documents, pages, items, cells, sections, typed = _typed(spark, sf_dir)
    there = (F.col("k") % 13 != 0) & (F.col("doc_id") % 5 != 0)
    old_pages = pages.where(there).withColumn("status", F.when(F.col("k") % 31 == 0, "good").otherwise(F.col("status")))
    old = typed.join(pages.select("doc_id", "page_index", "k"), document.PAGE).where(there & ~((F.col("k") % 29 == 0) & (F.col("seq") == 2)))
    old = old.withColumn("financial_type", F.when(F.col("k") % 37 == 0, "notes").otherwise(F.col("financial_type")))
    with_text = typed.join(items.select(*document.TABLE, "text"), document.TABLE)
    return documents, cells, checkers.findings(checkers.Model(documents, pages, with_text, cells, sections, old_pages, old), checkers.standard())


@query(f"WITH {_CHECKED} SELECT * FROM fi")
def document_findings(spark, sf_dir):
    return _checked(spark, sf_dir)[-1].drop("checker_order")


@query(f"WITH {_CHECKED} SELECT checker, severity, count(*) AS n FROM fi GROUP BY ALL")
def findings_by_checker(spark, sf_dir):
    return _checked(spark, sf_dir)[-1].groupBy("checker", "severity").agg(F.count("*").alias("n"))


@query(f"""WITH {_CHECKED}, cc AS (SELECT doc_id, count(*) AS n, count_if(regexp_full_match(text_raw, '\\s*')) AS blank, count_if(NOT regexp_full_match(text_raw, '\\s*') AND regexp_matches(text_raw, '[0-9]') AND v IS NULL) AS bad FROM nu GROUP BY doc_id)
SELECT doc_id, pdf, NOT coalesce(broken, false) AS schema_valid, coalesce(blank * 100.0::double / n, 0) AS blank_percent, coalesce(bad * 100.0::double / n, 0) AS unparsed_percent, coalesce(f, 0) AS findings
FROM dl LEFT JOIN cc USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS f, bool_or(checker = 'schema') AS broken FROM fi GROUP BY doc_id) USING (doc_id)""")
def qa_reports(spark, sf_dir):
    documents, cells, found = _checked(spark, sf_dir)
    return document.reports(documents, cells, found).withColumn("findings", F.size("findings").cast("long"))


@query(f"""WITH {_CHECKED} SELECT p.doc_id, p.pages, p.with_section, p.with_quality, i.items, i.with_type, i.toc_tables, i.toc_list_items FROM (SELECT doc_id, count(*) AS pages, count(section) AS with_section, count(status) AS with_quality FROM pq LEFT JOIN sc USING (doc_id, page_index) GROUP BY doc_id) p
JOIN (SELECT doc_id, count(*) AS items, count(financial_type) AS with_type, count_if(section = 'toc' AND semantic_type = 'table') AS toc_tables, count_if(section = 'toc' AND semantic_type = 'list_item') AS toc_list_items FROM ty JOIN sc USING (doc_id, page_index) GROUP BY doc_id) i USING (doc_id)""")
def result_counts(spark, sf_dir):
    _, pages, _, _, sections, typed = _typed(spark, sf_dir)
    return document.result_counts(pages, typed, sections)


@query(f"WITH {ad.PASSES} SELECT region_id, count(*) AS items, count(CASE WHEN pass % 4 <> 0 THEN pass END) AS with_pass, count_if(pass % 4 <> 0 AND pass > 1) AS several FROM passes GROUP BY region_id")
def passes_used(spark, sf_dir):
    x = ad.passes(spark, sf_dir)
    return document.passes_used(x.select("region_id", F.when(F.col("pass") % 4 != 0, F.col("pass")).alias("pass")), ["region_id"])


# ------------------------------------------------------------------ music

_BEAT = q.ORACLES["note_beats"]


@query(f"SELECT piece_id, count(*) AS notes, count_if(beat <> 0) AS placed FROM ({_BEAT}) GROUP BY piece_id")
def placed_notes(spark, sf_dir):
    return music.placed_share(music.positions(ad.notes(spark, sf_dir)))


@query(f"WITH {ad.NOTES_CTE}, {q._MEASURES} SELECT piece_id, count(*) AS wrong, string_agg(measure_seq || ':' || state, ',' ORDER BY measure_seq) AS which FROM ms WHERE state <> 'valid' GROUP BY piece_id")
def rhythm_errors(spark, sf_dir):
    e = music.rhythm_errors(ad.notes(spark, sf_dir))
    each = F.transform(F.split("errors", "; "), lambda x: F.concat(F.regexp_extract(x, r"^measure (\d+)", 1), F.lit(":"), F.regexp_extract(x, r": (\w+)", 1)))
    return e.select("piece_id", F.size(each).cast("long").alias("wrong"), F.array_join(each, ",").alias("which"))


@query(f"WITH {ad.NOTES_CTE}, m AS (SELECT piece_id, measure_seq, max(time_signature) AS t, max(key_signature) AS key FROM notes GROUP BY ALL), k AS (SELECT piece_id, arg_min(key, measure_seq) FILTER (key <> 'C') AS o, arg_min(key, measure_seq) AS a FROM m WHERE key IS NOT NULL GROUP BY piece_id), t AS (SELECT piece_id, arg_min(t, measure_seq) AS own FROM m WHERE t IS NOT NULL GROUP BY piece_id) SELECT m.piece_id, measure_seq, coalesce(key, o, a) AS key_signature, coalesce(own, CASE WHEN m.piece_id % 2 = 0 THEN '3/8' END, '4/4') AS time_signature FROM m LEFT JOIN k USING (piece_id) LEFT JOIN t USING (piece_id)")
def settled_measures(spark, sf_dir):
    m = ad.notes(spark, sf_dir).groupBy("piece_id", "measure_seq").agg(F.max("time_signature").alias("time_signature"), F.max("key_signature").alias("key_signature"))
    p = m.select("piece_id").distinct()
    staff = F.array(F.struct(F.lit(100).alias("top_y"), F.lit(140).alias("bottom_y")))
    tokens = p.select("piece_id", F.lit(0).alias("seq"), F.lit("header").alias("region"), F.when(F.col("piece_id") % 2 == 0, "3/8").otherwise("Allegro").alias("text"))
    hints = sheet.structure_hints(p.select("piece_id", staff.alias("staves"), F.lit(600).alias("width"), F.lit(800).alias("height")), tokens)
    return sheet.settled_measures(m, hints).select("piece_id", "measure_seq", "key_signature", "time_signature")
