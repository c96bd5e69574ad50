"""Registered queries over files, scores, passes, streams and kept results, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.html_tables import html_cells
from foliant.operators import contents, loc, moves, music, passes, regions
from foliant.plans import queries as q
from foliant.plans.queries import query
from foliant.sources import adapters as ad
from foliant.sources import files, folders, incremental
from foliant.sources.scratch import new_folder, saved
from foliant.streaming import breaker

# ------------------------------------------------------------------ files


def _below_parts(df: DataFrame) -> DataFrame:
    """Paths without the part folders that the sink makes."""
    return df.withColumn("path", F.regexp_replace("path", r"^part-\d+/", ""))


@query("SELECT coalesce(lang, 'none') || '/' || doc_id || '.md' AS path, strlen(c) AS size, sha256(c) AS content_sha256 FROM (SELECT *, '# ' || doc_id || chr(10) || chr(10) || coalesce(text, '') AS c FROM documents)")
def document_files(spark, sf_dir):
    """A Markdown file for each document, listed and read back."""
    d = ad.table(spark, sf_dir, "documents")
    name = F.concat(F.coalesce("lang", F.lit("none")), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md"))
    root = new_folder(spark, "document-files")
    files.write_files(d.select(name.alias("name"), F.concat(F.lit("# "), F.col("doc_id").cast("string"), F.lit("\n\n"), F.coalesce("text", F.lit(""))).alias("content")), root)
    listed = folders.list_files(spark, root)
    read = folders.read_contents(listed, root).select("path", F.sha2("content", 256).alias("content_sha256"))
    return _below_parts(listed.select("path", "size").join(read, "path"))


#: Names of source files, by document modulo 8; of two of them nothing is counted.
TREE = ("src/{0}/__init__.py", ".github/{0}.yml", "node_modules/{0}.js", "src/_private_{0}.c", "sql/{0}.sql", "src/.hidden_{0}.js", "docs/{0}.min.js", "data/{0}.json")
#: What lines of each kind look like, by line number modulo the number of forms.
FORMS = {"py": ("# {0}", "{0}", "  {0}  ", "{0} # no"), "js": ("/* {0} */", "/* {0}", "{0}", "{0} */", "{0} // why", "// {0}", "{0}"), "c": ("{0}", "/* {0}", "{0} */ {0}", "{0} // {0}"), "sql": ("-- {0}", "{0} -- no", "{0}")}
_KIND = {"yml": "py", "json": "sql"}


def _forms(suffix: str, at: str, text: str) -> str:
    """The form of a line by its number, in terms that Spark and DuckDB share."""
    forms = FORMS[_KIND.get(suffix, suffix)]
    say = lambda f: "concat(" + ", ".join([x for i, part in enumerate(f.split("{0}")) for x in ([text] if i else []) + ([f"'{part}'"] if part else [])] or ["''"]) + ")"
    return f"CASE {at} % {len(forms)} " + " ".join(f"WHEN {i} THEN {say(f)}" for i, f in enumerate(forms)) + " END"


_SUFFIX = [n.rpartition(".")[2] for n in TREE]
_TREE_SQL = f"""tree AS (SELECT doc_id, CASE doc_id % 8 {" ".join(f"WHEN {i} THEN '{n.split('{0}')[0]}' || doc_id || '{n.split('{0}')[1]}'" for i, n in enumerate(TREE))} END AS path, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
src AS (SELECT path, array_to_string(list_transform(range(0, len(l)), lambda i: CASE {" ".join(f"WHEN ends_with(path, '.{s}') THEN {_forms(s, 'i', 'l[i + 1]')}" for s in dict.fromkeys(_SUFFIX))} END), chr(10)) AS c FROM tree WHERE NOT (path LIKE 'node_modules/%' OR path LIKE '%.min.%')),
sl AS (SELECT path, (generate_subscripts(a, 1) - 1)::int AS line_no, regexp_replace(unnest(a), '^\\s+|\\s+$', '', 'g') AS t FROM (SELECT path, regexp_split_to_array(regexp_replace(c, '(\\r\\n|\\r|\\n)$', ''), '\\r\\n|\\r|\\n') AS a FROM src WHERE c <> '')),
s0 AS (SELECT *, CASE WHEN path LIKE '%.py' THEN 'Python' WHEN path LIKE '%.yml' THEN 'YAML' WHEN path LIKE '%.js' THEN 'JavaScript' WHEN path LIKE '%.c' THEN 'C' WHEN path LIKE '%.sql' THEN 'SQL' ELSE 'JSON' END AS language FROM sl),
s1 AS (SELECT *, language IN ('JavaScript', 'C') AS slash, CASE WHEN language NOT IN ('JavaScript', 'C') THEN NULL WHEN contains(t, '*/') THEN 0 WHEN contains(t, '/*') THEN 1 END AS mark FROM s0),
s2 AS (SELECT *, slash AND coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY path ORDER BY line_no), 0) = 1 AS ins, language IN ('Python', 'YAML') AND t[1] = '#' AS hash,
  CASE WHEN slash AND contains(t, '//') THEN trim(string_split(t, '//')[1]) WHEN language = 'SQL' AND contains(t, '--') THEN trim(string_split(t, '--')[1]) WHEN slash AND contains(t, '/*') AND contains(t, '*/') THEN trim(string_split(t, '/*')[1]) END AS tail FROM s1),
fl AS (SELECT path, language, sum((t <> '' AND NOT ins AND NOT hash AND coalesce(tail <> '', true))::int)::bigint AS code, sum((t <> '' AND (ins OR hash OR tail IS NOT NULL))::int)::bigint AS comments, sum((t = '')::int)::bigint AS blanks FROM s2 GROUP BY ALL HAVING count_if(t <> '') > 0)"""


@query(f"WITH {_TREE_SQL} SELECT * FROM fl")
def folder_lines(spark, sf_dir):
    """Documents as source files, hidden and excluded ones among them, scanned and counted."""
    path = "CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN concat('{n.split('{0}')[0]}', doc_id, '{n.split('{0}')[1]}')" for i, n in enumerate(TREE)) + " END"
    form = "CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN {_forms(s, 'i', 'x')}" for i, s in enumerate(_SUFFIX)) + " END"
    d = ad.table(spark, sf_dir, "documents").selectExpr(f"{path} AS name", rf"array_join(transform(split(coalesce(text, ''), '\n', -1), (x, i) -> {form}), '\n') AS content")
    root = new_folder(spark, "folder-lines")
    files.write_files(d, root)
    return _below_parts(loc.files(loc.read_lines(spark, root))).select("path", "language", "code", "comments", "blanks")


# ------------------------------------------------------------------ scores

_STEPS = "CDEFGAB"
_NOTES = f"""sn AS (SELECT user_id, i // 2048 AS v, i % 2048 AS i, (i % 2048) // 4 AS m, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events)),
sp AS (SELECT 'u' || user_id || '/' || v || '.xml' AS path, 'P' || (m % 2 + 1) AS part, user_id, i, m, event_id % 11 = 0 AS rest,
  '{_STEPS}'[(event_id % 7 + 1)::int] || CASE event_id % 4 WHEN 1 THEN '#' WHEN 2 THEN 'b' ELSE '' END || (2 + event_id % 5) AS pitch,
  CASE event_type WHEN 'error' THEN 'half' WHEN 'purchase' THEN 'eighth' WHEN 'signup' THEN '' WHEN 'view' THEN '16th' ELSE 'quarter' END AS duration FROM sn),
sm AS (SELECT path, part, m, user_id, row_number() OVER (PARTITION BY path ORDER BY part, m) - 1 AS measure_seq FROM sp GROUP BY path, part, m, user_id HAVING m % 3 = 0 OR count_if(NOT rest) > 0)"""


@query(f"WITH {_NOTES} SELECT path, measure_seq::int AS measure_seq, part, m::int AS number, (row_number() OVER (PARTITION BY path, part, m ORDER BY i) - 1)::int AS note_seq, pitch, duration, 1 AS voice FROM sp JOIN sm USING (path, part, m) WHERE NOT rest")
def score_notes(spark, sf_dir):
    """Events written as MusicXML, a file for 2048 of them, and read back."""
    return music.parse_musicxml(ad.scores(spark, sf_dir))


_FIFTHS = "['Cb', 'Gb', 'Db', 'Ab', 'Eb', 'Bb', 'F', 'C', 'G', 'D', 'A', 'E', 'B', 'F#', 'C#'][(user_id % 15 + 1)::int]"


@query(f"WITH {_NOTES} SELECT path, measure_seq::int AS measure_seq, part, m::int AS number, CASE WHEN m % 3 = 0 THEN (2 + m % 5) || '/4' END AS time_signature, CASE WHEN m % 3 = 0 THEN {_FIFTHS} END AS key_signature FROM sm")
def score_measures(spark, sf_dir):
    return music.parse_measures(ad.scores(spark, sf_dir))


# ------------------------------------------------------------------ passes

_TURN = "(conv_id * 1000 + coalesce(turn, 999))"
_READ = {1: "{t} || repeat('e', (length({t}) * 7 % 13)::int)", 2: "{t} || repeat('o', (length({t}) * 5 % 12)::int)", 3: "CASE WHEN {i} % 17 <> 0 THEN {t} || repeat('u', (length({t}) % 11)::int) END", 4: "{t}"}
_PASSES = f"""rg AS (SELECT {_TURN} AS region_id, coalesce(text, '') AS t FROM conversations),
ps AS ({" UNION ALL ".join(f"SELECT region_id, {k} AS pass, {e.format(t='t', i='region_id')} AS text FROM rg" for k, e in _READ.items())}),
q_in AS (SELECT region_id || '/' || pass AS id, text FROM ps),
{q.Q_SQL},
pq AS (SELECT region_id, pass, text, q.*, CASE WHEN text IS NULL THEN 999 ELSE repeat_run_max END AS run FROM ps JOIN q ON q.id = region_id || '/' || pass),
nx AS (SELECT region_id, 1 + c2 + c2 * c3 + c2 * c3 * c4 AS passes FROM (SELECT region_id, max((pass = 1 AND text <> '' AND (status = 'bad' OR run >= 10 OR (alpha_ratio < 0.3::double AND digit_ratio < 0.05::double)))::int) AS c2,
  max((pass = 2 AND run >= 8)::int) AS c3, max((pass = 3 AND run >= 8)::int) AS c4 FROM pq GROUP BY region_id)),
ch AS (SELECT pq.*, passes, row_number() OVER (PARTITION BY region_id ORDER BY coalesce(text, '') = '', CASE WHEN repeat_run_max >= 10 THEN -repeat_run_max WHEN repeat_run_max >= 8 THEN 10 - repeat_run_max ELSE 20 - repeat_run_max END DESC,
  0.4::double * alpha_ratio + 0.3::double * (1 - junk_token_ratio) + 0.2::double * least(avg_word_len / 8, 1.0::double) + 0.1::double * score DESC, pass) AS n FROM pq JOIN nx USING (region_id) WHERE pass <= passes)"""


@query(f"WITH {_PASSES} SELECT region_id, passes, pass, status, repeat_run_max FROM ch WHERE n = 1")
def adaptive_passes(spark, sf_dir):
    """Turns as regions, read by four engines of which each sees what the one before read badly."""
    r = ad.table(spark, sf_dir, "conversations").selectExpr("conv_id * 1000 + coalesce(turn, 999) AS region_id", "coalesce(text, '') AS t")
    exprs = ("concat(t, repeat('e', cast(length(t) * 7 % 13 AS int)))", "concat(t, repeat('o', cast(length(t) * 5 % 12 AS int)))", "CASE WHEN region_id % 17 <> 0 THEN concat(t, repeat('u', cast(length(t) % 11 AS int))) END", "t")
    engines = [lambda x, e=e: x.selectExpr("region_id", f"{e} AS text") for e in exprs]
    done = passes.adaptive_passes(r, engines)
    return passes.chosen_passes(done).selectExpr("region_id", "cast(passes AS int) AS passes", "pass", "status", "repeat_run_max")


_ONE = "CASE WHEN conv_id % 4 = 1 THEN ' ' WHEN role = 'user' AND conv_id % 3 <> 0 THEN text END"


@query(f"""WITH r AS (SELECT conv_id, turn AS region_id, text, {_ONE} AS one FROM conversations), p AS (SELECT DISTINCT conv_id FROM r WHERE trim(one) <> '')
SELECT conv_id, region_id, 1 AS engine, md5(one) AS text_md5 FROM r WHERE trim(one) <> '' UNION ALL SELECT conv_id, region_id, 2, md5(reverse(text)) FROM r ANTI JOIN p USING (conv_id) WHERE trim(text) <> ''""")
def fallback_regions(spark, sf_dir):
    """Turns as regions of conversations: a second engine reads those of which the first read nothing."""
    r = ad.table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("region_id"), "role", "text")
    first = lambda x: x.withColumn("text", F.expr(_ONE))
    x = passes.by_region(r, first, lambda x: x.withColumn("text", F.reverse("text")), ["conv_id"])
    return x.select("conv_id", "region_id", "engine", F.md5("text").alias("text_md5"))


# ------------------------------------------------------------------ tables that are none

_HAS = lambda col, words: f"regexp_matches({col}, '{'|'.join(words)}')"
_MOVES = f"""{ad.REPORT},
mc AS (SELECT doc_id, page_index, seq, row_idx, col_idx, cell_seq, CASE WHEN (doc_id + page_index) % 5 = 3 THEN regexp_replace(text_raw, '[0-9]', 'x', 'g') ELSE text_raw END AS text_raw FROM rc),
pt AS (SELECT doc_id, page_index, ' ' || string_agg(text, ' ' ORDER BY seq, c) AS t FROM (SELECT doc_id, page_index, seq, -1 AS c, text FROM ri WHERE kind = 'block' UNION ALL SELECT doc_id, page_index, seq, cell_seq, text_raw FROM mc) GROUP BY ALL),
tb AS (SELECT doc_id, page_index, seq, count(*) AS n, count(DISTINCT col_idx) >= 2 AND count_if(regexp_full_match(trim(text_raw), '[0-9,.()-]+')) * 10 >= count(*) AS valid, count(*) >= 3 AND ((count_if(regexp_matches(text_raw, '\\.{{2,}}'))::double / count(*) > 0.1 AND count_if(regexp_full_match(trim(text_raw), '[0-9]{{1,3}}'))::double / count(*) > 0.1)
  OR count_if(regexp_matches(text_raw, '\\.{{2,}}'))::double / count(*) > 0.2) AS toc FROM mc GROUP BY ALL),
pf AS (SELECT doc_id, page_index, {_HAS('lower(t)', ('sisällysluettelo', 'sisallysluettelo', 'contents'))} OR (len(regexp_extract_all(t, '[0-9]+\\.[0-9]+(?:\\.[0-9]+)?')) >= 3 AND len(regexp_extract_all(t, '\\.{{3,}}')) >= 2 AND len(regexp_extract_all(t, '\\b[0-9]{{1,3}}\\b')) >= 3)
  OR coalesce(x, false) AS page_toc FROM pt LEFT JOIN (SELECT doc_id, page_index, bool_or(toc) AS x FROM tb GROUP BY ALL) USING (doc_id, page_index)),
rt AS (SELECT ri.doc_id, ri.page_index, ri.seq, CASE WHEN coalesce(page_toc, false) OR coalesce(toc, false) THEN 'l' WHEN NOT coalesce(valid, false) THEN 'b' ELSE 't' END AS r FROM ri LEFT JOIN pf USING (doc_id, page_index) LEFT JOIN tb USING (doc_id, page_index, seq) WHERE kind = 'table'),
ev AS (SELECT doc_id, page_index, seq, 0 AS row, 'p' || page_index || '_b' || seq AS block_id, text, semantic_type FROM ri WHERE kind = 'block'
  UNION ALL SELECT doc_id, page_index, seq, row_idx, 'p' || page_index || '_b_toc_' || row_idx, trim(string_agg(trim(text_raw), ' ' ORDER BY col_idx, cell_seq)), 'list_item' FROM mc JOIN rt USING (doc_id, page_index, seq) WHERE r = 'l' GROUP BY doc_id, page_index, seq, row_idx HAVING trim(string_agg(trim(text_raw), ' ')) <> ''
  UNION ALL SELECT doc_id, page_index, seq, 0, 'p' || page_index || '_b_from_table_' || seq, string_agg(trim(text_raw), ' ' ORDER BY cell_seq) FILTER (trim(text_raw) <> ''), 'text' FROM mc JOIN rt USING (doc_id, page_index, seq) WHERE r = 'b' GROUP BY doc_id, page_index, seq HAVING count_if(trim(text_raw) <> '') > 0
  UNION ALL SELECT doc_id, page_index, seq, 0, NULL, NULL, NULL FROM rt WHERE r = 't'),
nw AS (SELECT *, (row_number() OVER (PARTITION BY doc_id, page_index ORDER BY seq, row, block_id IS NULL, block_id) - 1)::int AS new_seq FROM ev)"""


def _refined(spark, sf_dir):
    pages = saved(ad.report_pages(spark, sf_dir), "report-pages")
    items, cells = saved(ad.report_items(pages), "report-items"), ad.report_cells(spark, sf_dir, pages)
    lost = (F.col("doc_id") + F.col("page_index")) % 5 == 3
    cells = saved(cells.withColumn("text_raw", F.when(lost, F.regexp_replace("text_raw", "[0-9]", "x")).otherwise(F.col("text_raw"))), "report-cells")
    return moves.refined(items.where("kind = 'block'"), items.where("kind = 'table'").select(*moves.TABLE), cells)


@query(f"WITH {_MOVES} SELECT doc_id, page_index, new_seq AS seq, block_id, text, semantic_type FROM nw WHERE block_id IS NOT NULL")
def refined_blocks(spark, sf_dir):
    """Blocks of the reports after tables of contents, and tables without numbers, have become blocks."""
    return _refined(spark, sf_dir)[0]


@query(f"WITH {_MOVES} SELECT doc_id, page_index, new_seq AS seq, n AS cells FROM nw JOIN tb USING (doc_id, page_index, seq) WHERE block_id IS NULL")
def refined_tables(spark, sf_dir):
    _, tables, cells = _refined(spark, sf_dir)
    n = cells.groupBy(*moves.TABLE).agg(F.count("*").alias("cells"))
    return tables.join(n, moves.TABLE)


_SHOWN = """sb AS (SELECT o_custkey AS doc_id, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)::int AS page_index, o_orderkey AS k,
  CASE o_orderkey % 5 WHEN 0 THEN ' ' || (o_orderkey % 230) || ' ' WHEN 1 THEN 'Sivu ' || (o_orderkey % 97) WHEN 2 THEN 'see page' || (o_orderkey % 41) || ' of it' WHEN 3 THEN o_orderpriority ELSE (o_orderkey % 17)::varchar END AS text, [20.0, 400.0, 800.0, 84.0][(o_orderkey % 4 + 1)::int]::double AS y0 FROM orders),
sx AS (SELECT doc_id, page_index, y0 > 842 * 0.85::double OR y0 + 15 > 842 * 0.85::double AS foot, y0 < 842 * 0.10::double AS head, try_cast(regexp_extract(trim(text), '^([0-9]{1,3})$', 1) AS int) AS alone, try_cast(regexp_extract(lower(trim(text)), '(?:sivu|page)\\s*([0-9]{1,3})', 1) AS int) AS named FROM sb WHERE page_index BETWEEN 3 AND 14),
oc AS (SELECT doc_id, page_index - unnest([CASE WHEN foot AND alone BETWEEN 1 AND 200 THEN alone END, CASE WHEN foot AND named BETWEEN 1 AND 200 THEN named END, CASE WHEN head AND alone BETWEEN 1 AND 200 THEN alone END]) AS off FROM sx)"""


@query(f"""WITH {_SHOWN} SELECT doc_id, "offset", count(*) AS n FROM (SELECT doc_id, off AS "offset" FROM oc WHERE off IS NOT NULL) GROUP BY ALL""")
def shown_page_numbers(spark, sf_dir):
    """How far printed page numbers are from the place of their pages: at the foot, at the head, alone or behind a word."""
    o = ad.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    n = (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).cast("int")
    number = lambda m: (k % m).cast("string")
    text = F.when(k % 5 == 0, F.concat(F.lit(" "), number(230), F.lit(" "))).when(k % 5 == 1, F.concat(F.lit("Sivu "), number(97))).when(k % 5 == 2, F.concat(F.lit("see page"), number(41), F.lit(" of it"))).when(k % 5 == 3, F.col("o_orderpriority")).otherwise(number(17))
    y = F.element_at(F.array(*[F.lit(v) for v in (20.0, 400.0, 800.0, 84.0)]), (k % 4 + 1).cast("int"))
    b = o.select(F.col("o_custkey").alias("doc_id"), n.alias("page_index"), n.alias("page_no"), text.alias("text"), y.alias("y0"), (y + 15).alias("y1"), F.lit(842.0).alias("height"))
    return contents.offset_candidates(b).groupBy("doc_id", "offset").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------ streams and kept results

SLICES = 4


@query("""WITH c AS (SELECT 'engine-' || (user_id % 50) AS engine, event_id AS call_id, CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN CASE WHEN event_id % 5 = 0 THEN 3 ELSE 0 END ELSE 0 END AS w FROM events),
b AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY engine ORDER BY call_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)
SELECT engine, call_id, before < 3 AS called, CASE WHEN before < 3 THEN least(before + w, 3) ELSE 3 END::int AS failures FROM b""")
def engine_breaker(spark, sf_dir):
    """Events as calls of engines, in slices that arrive one after another: the stream ends after each and goes on from its checkpoint."""
    e = ad.table(spark, sf_dir, "events")
    outcome = F.when(F.col("event_type") == "error", breaker.FAILED).when((F.col("event_type") == "signup") & (F.col("event_id") % 5 == 0), breaker.MISSING).otherwise("fine")
    calls = e.select(F.concat(F.lit("engine-"), (F.col("user_id") % 50).cast("string")).alias("engine"), F.col("event_id").alias("call_id"), outcome.alias("outcome"))
    edges = calls.select(F.percentile_approx("call_id", F.array(*[F.lit(i / SLICES) for i in range(1, SLICES)]), F.lit(10_000)).alias("e")).first()["e"] or [0] * (SLICES - 1)
    source, out, checkpoint = (new_folder(spark, f"breaker-{n}") for n in ("in", "out", "checkpoint"))
    calls.limit(0).write.parquet(source)
    bounds = [None, *edges, None]
    for low, high in zip(bounds, bounds[1:], strict=False):
        part = calls if low is None else calls.where(F.col("call_id") > low)
        (part if high is None else part.where(F.col("call_id") <= high)).write.mode("append").parquet(source)
        stream = spark.readStream.schema("engine string, call_id long, outcome string").parquet(source)
        run = breaker.breaker(stream).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run.awaitTermination()
    return spark.read.schema(breaker.SCHEMA).parquet(out)


_CHANGED = "CASE WHEN page_id % 100 = 0 THEN coalesce(html, '') || '<p>more</p>' ELSE html END"


@query(f"SELECT page_id, (page_id % 100 = 0)::bigint AS run, length(regexp_replace(coalesce(h, ''), '<[^>]*>', '', 'g')) AS chars, len(regexp_extract_all(coalesce(h, ''), '<p>')) AS paragraphs FROM (SELECT page_id, {_CHANGED} AS h FROM pages WHERE page_id % 200 <> 7)")
def incremental_pages(spark, sf_dir):
    """Pages read twice: between the runs a hundredth changes and some go; only what changed is computed again."""
    p = ad.table(spark, sf_dir, "pages").select("page_id", "html")
    html = F.coalesce("html", F.lit(""))
    compute = lambda x: x.select("page_id", F.length(F.regexp_replace(html, "<[^>]*>", "")).alias("chars"), F.regexp_count(html, F.lit("<p>")).alias("paragraphs"))
    folder = new_folder(spark, "incremental-pages")
    incremental.refresh(p, "page_id", ["html"], compute, folder)
    later = p.where("page_id % 200 <> 7").withColumn("html", F.when(F.col("page_id") % 100 == 0, F.concat(html, F.lit("<p>more</p>"))).otherwise(F.col("html")))
    return incremental.refresh(later, "page_id", ["html"], compute, folder).select("page_id", "run", "chars", "paragraphs")


# ------------------------------------------------------------------ regions

_STAVES = "list_transform(range(0, label % 5), lambda i: {'gap': 5 + floor(abs(embedding[2 * i + 1]::double) * 300)::bigint, 'tall': 20 + floor(abs(embedding[2 * i + 2]::double) * 200)::bigint})"
_REGIONS = f"""s0 AS (SELECT vec_id AS img_id, 600 + (vec_id % 5) * 100 AS w, 300 + (vec_id % 7) * 150 AS h, {_STAVES} AS p FROM embeddings),
s1 AS (SELECT *, list_transform(range(1, len(p) + 1), lambda i: {{'top_y': coalesce(list_sum(list_transform(p[:i - 1], lambda z: z.gap + z.tall)), 0)::bigint + p[i].gap, 'bottom_y': coalesce(list_sum(list_transform(p[:i - 1], lambda z: z.gap + z.tall)), 0)::bigint + p[i].gap + p[i].tall}}) AS s FROM s0),
s2 AS (SELECT *, coalesce(s[-1].bottom_y + 40, floor(h * 0.92::double)::bigint) AS foot, coalesce(s[1].top_y - 20, floor(h * 0.15::double)::bigint) AS head FROM s1),
rg AS (SELECT img_id, 'header' AS name, 0 AS x0, 0 AS y0, w AS x1, least(greatest(10, head), h) AS y1 FROM s2
  UNION ALL SELECT img_id, 'footer', 0, foot, w, h FROM s2 WHERE foot < h - 10
  UNION ALL SELECT img_id, 'between_staff_' || (i - 1) || '_' || i, floor(w * 0.05::double)::bigint, s[i].bottom_y + 15, floor(w * 0.95::double)::bigint, least(s[i + 1].top_y - 15, h) FROM (SELECT *, unnest(range(1, len(s))) AS i FROM s2) WHERE s[i + 1].top_y - 15 > s[i].bottom_y + 15 + 10)"""


@query(f"WITH {_REGIONS} SELECT img_id, name, x0::int AS x0, y0::int AS y0, x1::int AS x1, y1::int AS y1 FROM rg WHERE x1 > x0 AND y1 > y0")
def sheet_regions(spark, sf_dir):
    """Vectors as sheets: their entries are the gaps between staves and the staves' heights."""
    e = ad.table(spark, sf_dir, "embeddings")
    far = lambda i, k: F.floor(F.abs(F.get("embedding", i).cast("double")) * k)
    pairs = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.struct((far(2 * i, 300) + 5).alias("gap"), (far(2 * i + 1, 200) + 20).alias("tall")))
    pairs = F.slice(pairs, F.lit(1), F.col("label") % 5)
    start = F.struct(F.lit(0).cast("long").alias("y"), F.array().cast("array<struct<top_y:long,bottom_y:long>>").alias("s"))
    add = lambda a, p: F.struct((a["y"] + p["gap"] + p["tall"]).alias("y"), F.concat(a["s"], F.array(F.struct((a["y"] + p["gap"]).alias("top_y"), (a["y"] + p["gap"] + p["tall"]).alias("bottom_y")))).alias("s"))
    v = F.col("vec_id")
    return regions.sheet_regions(e.select(v.alias("img_id"), (600 + v % 5 * 100).alias("width"), (300 + v % 7 * 150).alias("height"), F.aggregate(pairs, start, add)["s"].alias("staves")))


_SEGMENTS = """li AS (SELECT l_orderkey AS page_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n, l_partkey AS p, l_suppkey AS s, round(l_quantity)::bigint AS q FROM lineitem),
sg AS (SELECT page_id, n * 2 AS id, 'h' AS kind, (p % 300)::double AS x0, (s * 7 % 400)::double AS y0, (p % 300 + 60 + q * 4)::double AS x1, (s * 7 % 400)::double AS y1 FROM li
  UNION ALL SELECT page_id, n * 2 + 1, 'v', (p % 300 + q)::double, (s * 7 % 400 - 20)::double, (p % 300 + q)::double, (s * 7 % 400 + 40 + q * 5)::double FROM li),
tg AS (SELECT a.page_id, a.id AS a, b.id AS b FROM sg a JOIN sg b ON a.page_id = b.page_id AND a.id <> b.id AND a.x0 <= b.x1 + 5 AND b.x0 <= a.x1 + 5 AND a.y0 <= b.y1 + 5 AND b.y0 <= a.y1 + 5)"""


def _segments(spark, sf_dir):
    x = ad.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS page_id", "l_linenumber", "l_partkey AS p", "l_suppkey AS s", "cast(round(l_quantity) AS bigint) AS q", "l_extendedprice")
    x = x.withColumn("n", F.row_number().over(Window.partitionBy("page_id").orderBy("l_linenumber", "p", "s", "l_extendedprice")))
    h = "named_struct('segment_id', n * 2, 'kind', 'h', 'x0', double(p % 300), 'y0', double(s * 7 % 400), 'x1', double(p % 300 + 60 + q * 4), 'y1', double(s * 7 % 400))"
    v = "named_struct('segment_id', n * 2 + 1, 'kind', 'v', 'x0', double(p % 300 + q), 'y0', double(s * 7 % 400 - 20), 'x1', double(p % 300 + q), 'y1', double(s * 7 % 400 + 40 + q * 5))"
    return x.selectExpr("page_id", f"inline(array({h}, {v}))")


@query(f"""WITH RECURSIVE {_SEGMENTS}, rc AS (SELECT page_id, id, id AS c FROM sg UNION SELECT tg.page_id, tg.b, rc.c FROM rc JOIN tg ON rc.page_id = tg.page_id AND rc.id = tg.a),
cm AS (SELECT page_id, id, min(c) AS c FROM rc GROUP BY ALL), bx AS (SELECT page_id, c, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, count(*) AS lines, count(DISTINCT kind) AS kinds FROM sg JOIN cm USING (page_id, id) GROUP BY ALL)
SELECT page_id, x0, y0, x1, y1, lines, 0.7::double AS confidence FROM bx WHERE kinds = 2 AND x1 - x0 > 100 AND y1 - y0 > 100""")
def drawn_tables(spark, sf_dir):
    """Order lines as ruled lines on pages, one each way: tables are groups of lines that touch."""
    return regions.drawn_tables(_segments(spark, sf_dir))


@query(f"WITH {_SEGMENTS} SELECT page_id, x0, y0, x1, y1, 0.7::double AS confidence FROM (SELECT page_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM sg GROUP BY page_id HAVING count(DISTINCT kind) = 2) WHERE x1 - x0 > 100 AND y1 - y0 > 100")
def page_table_boxes(spark, sf_dir):
    return regions.page_tables(_segments(spark, sf_dir))


_LINKS = "list_transform(regexp_extract_all(html, '<li><a[^>]*>([^<]*)</a>', 1), lambda x: regexp_replace(replace(x, '&', ''), '\\s+', ' ', 'g'))"


@query(f"""WITH w AS (SELECT page_id, {_LINKS} AS w FROM pages), x AS (SELECT page_id, len(w) AS n, unnest(range(0, len(w))) AS i, unnest(w) AS t FROM w)
SELECT page_id, 0 AS table_no, NULL::int AS parent_no, i::int AS row_idx, c.k AS col_idx, 1 AS rowspan, 1 AS colspan, CASE c.k WHEN 0 THEN trim(t) ELSE 'x' END AS text_raw FROM x, (SELECT unnest([0, 1]) AS k) c
UNION ALL SELECT page_id, (i + 1)::int, 0, 0, c.k, 1, 1 + c.k, CASE c.k WHEN 0 THEN i::varchar ELSE trim(t) END FROM x, (SELECT unnest([0, 1]) AS k) c
UNION ALL SELECT page_id, 0, NULL, (len(w) + c.r)::int, c.k, CASE c.k WHEN 0 THEN 3 ELSE 1 END, 1, c.t FROM w, (SELECT unnest([0, 0, 1, 2]) AS r, unnest([0, 1, 1, 1]) AS k, unnest(['a', 'b & b', 'c', 'd']) AS t) c""")
def nested_html_cells(spark, sf_dir):
    """The links of pages as nested tables with spans and missing end tags, read by a table function."""
    links = F.transform(F.regexp_extract_all("html", F.lit("<li><a[^>]*>([^<]*)</a>"), F.lit(1)), lambda x: F.regexp_replace(F.replace(x, F.lit("&"), F.lit("")), r"\s+", " "))
    row = lambda x, i: F.concat(F.lit("<tr><td class=c>"), x, F.lit(" <table><tr><td>"), i.cast("string"), F.lit("<td colspan='2'> "), x, F.lit("</table><td>x</td>"))
    html = F.concat(F.lit("<p>no</p><TABLE><thead></thead>"), F.array_join(F.transform(links, row), "\n"), F.lit("<tr><td rowspan=3>a<td>b &amp; b<tr><td>c</td></tr><tr><td><b>d</b></table>tail"))
    return html_cells(ad.table(spark, sf_dir, "pages").select("page_id", html.alias("html")), "page_id")
