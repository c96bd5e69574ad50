"""Document-shaped relations derived from the star-schema and text tables.

Each adapter is a lazy DataFrame; the constant beside it is the same relation as a DuckDB CTE, for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """rows of a scan, dealt anew where its files make fewer partitions than there are cores: for work that is far heavier than moving its rows."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as text blocks on pages of 20, in two columns, with boxes in points (595 x 842)."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))
    x0 = (F.lit(40) + F.lit(260) * ((F.col("pos") + F.col("doc_id")) % 2)).cast("double")
    y0 = (F.lit(30) + F.lit(38) * (F.col("pos") * 7 % 20)).cast("double")
    return d.select("doc_id", F.expr("pos div 20").cast("int").alias("page_index"), F.col("pos").alias("seq"), "text", x0.alias("x0"), y0.alias("y0"), (x0 + 220).alias("x1"), (y0 + 20).alias("y1"), F.lit(842.0).alias("height"))


BLOCKS = """blocks AS (
  SELECT doc_id, (pos // 20)::int AS page_index, pos AS seq, text, (40 + 260 * ((pos + doc_id) % 2))::double AS x0, (30 + 38 * (pos * 7 % 20))::double AS y0,
         (40 + 260 * ((pos + doc_id) % 2))::double + 220 AS x1, (30 + 38 * (pos * 7 % 20))::double + 20 AS y1, 842.0::double AS height
  FROM (SELECT doc_id, (generate_subscripts(a, 1) - 1)::int AS pos, unnest(a) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents)))"""


def _money(cents: str) -> str:
    return f"concat({cents} div 100, ',', lpad({cents} % 100, 2, '0'))"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as tables: a row per line (label, quantity, price, tax) and a total row, numbers as written text."""
    x = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS table_id", "l_linenumber", "l_partkey", "l_suppkey", "cast(round(l_quantity) AS bigint) AS qty", "cast(round(l_extendedprice * 100) AS bigint) AS cents", "cast(round(l_tax * 100) AS bigint) AS rate", "l_shipdate", "l_discount")
    x = x.withColumn("tax", F.expr("cents * rate div 100"))
    order = Window.partitionBy("table_id").orderBy("l_linenumber", "l_partkey", "l_suppkey", "cents", "qty", "rate", "l_discount", "l_shipdate")
    lines = x.withColumn("row_idx", (F.row_number().over(order) - 1).cast("int"))
    style = lambda t: f"case when table_id % 3 = 0 then concat('(', {t}, ')') else {t} end"
    euro = lambda t: f"case when table_id % 5 = 0 then concat({t}, ' €') else {t} end"
    body = lines.selectExpr("table_id", "row_idx", f"array(concat('Item ', row_idx), cast(qty AS string), case when table_id % 7 = 0 then '' else {euro(style(_money('cents')))} end, {euro(_money('tax'))}) AS v")
    total = lines.groupBy("table_id").agg(F.count("*").cast("int").alias("row_idx"), F.sum("cents").alias("p"), F.sum("tax").alias("t"))
    total = total.selectExpr("table_id", "row_idx", f"array('Yhteensä', {_money('p')}, {_money('t')}, {_money('(p + t + case when table_id % 4 = 0 then 100 else 0 end)')}) AS v")
    both = body.unionByName(total).select("table_id", "row_idx", F.posexplode("v").alias("col_idx", "text_raw"))
    return both.select("table_id", "row_idx", "col_idx", (F.col("row_idx") * 4 + F.col("col_idx")).alias("cell_seq"), "text_raw")


_M = "({0} // 100)::varchar || ',' || lpad(({0} % 100)::varchar, 2, '0')"
_STYLED = "CASE WHEN table_id % 3 = 0 THEN '(' || " + _M.format("cents") + " || ')' ELSE " + _M.format("cents") + " END"
CELLS = f"""li AS (
  SELECT *, cents * rate // 100 AS tax, (row_number() OVER (PARTITION BY table_id ORDER BY l_linenumber, l_partkey, l_suppkey, cents, qty, rate, l_discount, l_shipdate) - 1)::int AS row_idx
  FROM (SELECT l_orderkey AS table_id, l_linenumber, l_partkey, l_suppkey, round(l_quantity)::bigint AS qty, round(l_extendedprice * 100)::bigint AS cents,
               round(l_tax * 100)::bigint AS rate, l_shipdate, l_discount FROM lineitem)),
cells AS (
  SELECT table_id, row_idx, (generate_subscripts(v, 1) - 1)::int AS col_idx, (row_idx * 4 + generate_subscripts(v, 1) - 1)::int AS cell_seq, unnest(v) AS text_raw FROM (
    SELECT table_id, row_idx, ['Item ' || row_idx, qty::varchar, CASE WHEN table_id % 7 = 0 THEN '' WHEN table_id % 5 = 0 THEN ({_STYLED}) || ' €' ELSE {_STYLED} END,
           CASE WHEN table_id % 5 = 0 THEN {_M.format("tax")} || ' €' ELSE {_M.format("tax")} END] AS v FROM li
    UNION ALL
    SELECT table_id, n, ['Yhteensä', {_M.format("p")}, {_M.format("t")}, {_M.format("(p + t + CASE WHEN table_id % 4 = 0 THEN 100 ELSE 0 END)")}]
    FROM (SELECT table_id, count(*)::int AS n, sum(cents)::bigint AS p, sum(tax)::bigint AS t FROM li GROUP BY table_id)))"""


def balance_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer a table of two rows (label, last year, this year), assets and liabilities, which differ by 0, 0.3, 2 or 20 per cent."""
    a = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("table_id")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("a"))
    return _balance(a, ["table_id"], "table_id")


def _balance(a: DataFrame, keys: list[str], by: str) -> DataFrame:
    more = F.expr(f"case {by} % 4 when 0 then 0 when 1 then a * 3 div 1000 when 2 then a * 2 div 100 else a * 20 div 100 end")
    a = a.withColumn("l", F.col("a") + more)
    rows = F.expr(f"array(array('Vastaavaa yhteensä', '1,0', {_money('a')}), array('Vastattavaa yhteensä', '2,0', {_money('l')}))")
    x = a.select(*keys, F.posexplode(rows).alias("row_idx", "v")).select(*keys, "row_idx", F.posexplode("v").alias("col_idx", "text_raw"))
    return x.select(*keys, "row_idx", "col_idx", (F.col("row_idx") * 3 + F.col("col_idx")).alias("cell_seq"), "text_raw")


def _balance_sql(name: str, source: str, keys: str, by: str) -> str:
    return f"""{name}_l AS (SELECT *, a + CASE {by} % 4 WHEN 0 THEN 0 WHEN 1 THEN a * 3 // 1000 WHEN 2 THEN a * 2 // 100 ELSE a * 20 // 100 END AS l FROM {source}),
{name} AS (SELECT {keys}, row_idx, (generate_subscripts(v, 1) - 1)::int AS col_idx, (row_idx * 3 + generate_subscripts(v, 1) - 1)::int AS cell_seq, unnest(v) AS text_raw FROM (
  SELECT {keys}, 0 AS row_idx, ['Vastaavaa yhteensä', '1,0', {_M.format("a")}] AS v FROM {name}_l UNION ALL SELECT {keys}, 1, ['Vastattavaa yhteensä', '2,0', {_M.format("l")}] FROM {name}_l))"""


BALANCE_CELLS = "bt AS (SELECT o_custkey AS table_id, sum(round(o_totalprice * 100)::bigint)::bigint AS a FROM orders GROUP BY o_custkey),\n" + _balance_sql("balance_cells", "bt", "table_id", "table_id")

#: Titles of contents entries, by part key modulo 6.
TITLES = ("Tuloslaskelma", "Rahoituslaskelma", "Tase", "Liitetiedot", "Notes", "Muut tiedot")


def toc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as contents lines, 20 to a page: number, title, dots, target page (some of them out of range)."""
    title = F.element_at(F.array(*[F.lit(t) for t in TITLES]), (F.col("p_partkey") % 6 + 1).cast("int"))
    page = (F.col("p_partkey") % 600 + 1).cast("string")
    number = F.concat((F.expr("p_partkey div 10") % 10).cast("string"), F.lit("."), (F.col("p_partkey") % 10).cast("string"))
    return table(spark, sf_dir, "part").select(F.expr("cast(p_partkey div 20 AS int)").alias("page_index"), F.col("p_partkey").alias("seq"), F.concat(number, F.lit(" "), title, F.lit(" .... "), page).alias("text"))


TOC_LINES = """toc AS (SELECT (p_partkey // 20)::int AS page_index, p_partkey AS seq,
  (p_partkey // 10 % 10) || '.' || (p_partkey % 10) || ' ' || ['Tuloslaskelma', 'Rahoituslaskelma', 'Tase', 'Liitetiedot', 'Notes', 'Muut tiedot'][p_partkey % 6 + 1] || ' .... ' || (p_partkey % 600 + 1) AS text FROM part)"""


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sentences that refer to notes 0 to 39."""
    n = (F.col("o_orderkey") % 40).cast("string")
    t = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("see note "), n)).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("Liite "), n)).otherwise(F.concat(F.lit("ks. liite "), n))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("block_id"), F.expr("cast(o_orderkey div 50 AS int)").alias("page_index"), t.alias("text"))


REFERENCES = """refs AS (SELECT o_orderkey AS block_id, (o_orderkey // 50)::int AS page_index,
  CASE o_orderkey % 3 WHEN 0 THEN 'see note ' WHEN 1 THEN 'Liite ' ELSE 'ks. liite ' END || (o_orderkey % 40) AS text FROM orders)"""


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notes that exist: those referred to by number, but for every third."""
    n = F.col("o_orderkey") % 40
    return table(spark, sf_dir, "orders").select(n.cast("string").alias("note")).where(n % 3 != 0).distinct()


DEFINITIONS = "defs AS (SELECT DISTINCT (o_orderkey % 40)::varchar AS note FROM orders WHERE o_orderkey % 40 % 3 <> 0)"


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as notes: a user is a piece, four events in time make a measure, the type is the duration."""
    e = table(spark, sf_dir, "events")
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    e = e.select(F.col("user_id").alias("piece_id"), i.alias("i"), "event_type")
    kind = F.create_map(*[F.lit(x) for x in ("click", "quarter", "error", "half", "purchase", "eighth", "signup", "16th", "view", "quarter")])
    sig = F.element_at(F.array(F.lit(None).cast("string"), F.lit("4/4"), F.lit("3/4"), F.lit("6/8"), F.lit("C")), (F.col("piece_id") % 5 + 1).cast("int"))
    m = F.expr("cast(i div 4 AS int)")
    key = F.when((F.col("piece_id") + m) % 7 == 3, "G").when((F.col("piece_id") + m) % 7 == 5, "C")
    return e.select("piece_id", m.alias("measure_seq"), (F.col("i") % 4).cast("int").alias("note_seq"), F.coalesce(F.try_element_at(kind, F.col("event_type")), F.lit("quarter")).alias("duration"), sig.alias("time_signature"), key.alias("key_signature"))


NOTES_CTE = """notes AS (SELECT piece_id, (i // 4)::int AS measure_seq, (i % 4)::int AS note_seq,
    CASE event_type WHEN 'error' THEN 'half' WHEN 'purchase' THEN 'eighth' WHEN 'signup' THEN '16th' ELSE 'quarter' END AS duration,
    [NULL, '4/4', '3/4', '6/8', 'C'][piece_id % 5 + 1] AS time_signature,
    CASE (piece_id + i // 4) % 7 WHEN 3 THEN 'G' WHEN 5 THEN 'C' END AS key_signature
  FROM (SELECT user_id AS piece_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events))"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as MusicXML: path and content of a file for each 2048 of a user's, with two parts, measures of four notes, and all that readers stumble over."""
    e = table(spark, sf_dir, "events")
    i = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    e = e.select("user_id", "event_id", "event_type", i.alias("_i")).selectExpr("user_id", "event_id", "event_type", "_i div 2048 AS v", "_i % 2048 AS i", "_i % 2048 div 4 AS m")
    kind = "CASE event_type WHEN 'error' THEN '<type size=\"cue\">half</type>' WHEN 'purchase' THEN '<type>eighth</type>' WHEN 'signup' THEN '<type/>' WHEN 'view' THEN ' <type >16th</type>' ELSE '' END"
    alter = "CASE event_id % 4 WHEN 0 THEN '' ELSE concat('<alter>', elt(cast(event_id % 4 AS int), '1', '-1', '2'), '</alter>') END"
    note = f"CASE WHEN event_id % 11 = 0 THEN '<note><rest/><type>half</type></note>' ELSE concat('<note default-x=\"1\"><pitch><step>', substr('CDEFGAB', cast(event_id % 7 + 1 AS int), 1), '</step>', {alter}, '<octave>', 2 + event_id % 5, '</octave></pitch>', {kind}, '</note>') END"
    joined = lambda order, text: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), "")
    m = e.selectExpr("user_id", "v", "m", "i", f"{note} AS note").groupBy("user_id", "v", "m").agg(joined("i", "note").alias("notes"))
    stated = "CASE m % 3 WHEN 0 THEN concat('<attributes><divisions>1</divisions><key><fifths>', user_id % 15 - 7, '</fifths></key><time><beats>', 2 + m % 5, '</beats><beat-type>4</beat-type></time></attributes>') WHEN 1 THEN '<attributes/>' ELSE '' END"
    p = m.selectExpr("user_id", "v", "m % 2 AS part", "m", f"concat('<measure number=\"', m, '\" width=\"9\">', {stated}, notes, '</measure>') AS measure").groupBy("user_id", "v", "part").agg(joined("m", "measure").alias("measures"))
    s = p.selectExpr("user_id", "v", "part", "concat('<part id=\"P', part + 1, '\"><measure number=\"0\"/>', measures, '</part>') AS body").groupBy("user_id", "v").agg(joined("part", "body").alias("body"))
    space = "CASE WHEN user_id % 3 = 0 THEN ' xmlns=\"http://www.musicxml.org/xsd/3.1\"' ELSE '' END"
    head = "<?xml version=\"1.0\" encoding=\"UTF-8\"?><!DOCTYPE score-partwise PUBLIC \"-//x//y\" \"http://localhost/none.dtd\">"
    return s.selectExpr("concat('u', user_id, '/', v, '.xml') AS path", f"concat('{head}<score-partwise', {space}, '><part-list/>', body, '</score-partwise>') AS content")


def passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as recognition passes over a region; every third region degrades from pass to pass."""
    c = table(spark, sf_dir, "conversations")
    noise = F.when(F.col("conv_id") % 3 == 0, F.repeat(F.lit("e"), (F.col("turn") * 4).cast("int"))).otherwise("")
    return c.select(F.col("conv_id").alias("region_id"), (F.col("turn") + 1).cast("int").alias("pass"), F.concat(F.coalesce("text", F.lit("")), noise).alias("text"))


PASSES = """passes AS (SELECT conv_id AS region_id, (turn + 1)::int AS pass, coalesce(text, '') || CASE WHEN conv_id % 3 = 0 THEN repeat('e', (turn * 4)::int) ELSE '' END AS text FROM conversations)"""


def golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items per source in an earlier snapshot: without every seventh document, with a source that is gone now."""
    d = table(spark, sf_dir, "documents")
    old = d.where("doc_id % 7 <> 0").select("source")
    gone = d.where("doc_id % 97 = 0").select(F.lit("gone").alias("source"))
    return old.unionByName(gone)


GOLDEN = "golden AS (SELECT source FROM documents WHERE doc_id % 7 <> 0 UNION ALL SELECT 'gone' FROM documents WHERE doc_id % 97 = 0)"


def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of source lines: pages as HTML, documents as Markdown, benchmark items as text."""
    p = table(spark, sf_dir, "pages").select(F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"), F.regexp_replace("html", "><", ">\n<").alias("text"))
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), "text")
    b = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("bench/"), F.col("item_id").cast("string"), F.lit(".txt")).alias("path"), "text")
    u = p.unionByName(d).unionByName(b)
    return u.select("path", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text"))


SOURCE_LINES = """files AS (SELECT 'pages/' || page_id || '.html' AS path, replace(html, '><', '>' || chr(10) || '<') AS text FROM pages
  UNION ALL SELECT 'docs/' || doc_id || '.md', text FROM documents UNION ALL SELECT 'bench/' || item_id || '.txt', text FROM benchmark),
src_lines AS (SELECT path, (generate_subscripts(a, 1) - 1)::int AS line_no, unnest(a) AS text FROM (SELECT path, string_split(text, chr(10)) AS a FROM files))"""


# ------------------------------------------------------------------ whole documents

#: First lines of a report's pages, by order key modulo 12, and a line further down, modulo 9.
HEADS = ("Vuosikertomus", "Sisällysluettelo", "Tase", "Tuloslaskelma", "Rahoituslaskelma", "Liitetiedot", "Hallituksen kertomus", "Tilinpäätöksen laatimisperiaatteet", "Muut tiedot", "Yhteystiedot", "Sisällys", "Kaaviot")
LINES = ("Vastaavaa, vastattavaa", "Toimintatuotot ja vuosikate", "Toiminnan rahavirta, rahavarojen muutos", "eeeeeeeeeeee", "Kuvaus", "- kohta", "", "12 34 5", "liite " + "sana " * 120)


def _pick(values, i):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as reports, their orders (k) as pages; some pages have no width."""
    o = table(spark, sf_dir, "orders")
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    return o.select(F.col("o_custkey").alias("doc_id"), n.cast("int").alias("page_index"), F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 101 == 0, 0.0).otherwise(595.0).alias("width"), F.lit(842.0).alias("height"), F.round(F.col("o_totalprice") * 100).cast("long").alias("a"))


def report_items(pages: DataFrame) -> DataFrame:
    """Four blocks a page (head, contents line or reference or note, phrase, page number), and up to two tables."""
    k = F.col("k")
    n17 = (k % 17).cast("string")
    second = F.when((k % 12).isin(1, 10), F.concat((k % 9).cast("string"), F.lit(".1 Tase .... "), (k % 7 + 1).cast("string"))).when(k % 12 == 5, F.concat(n17, F.lit(". Selite")))
    second = second.when(k % 3 == 0, F.concat(F.lit("see note "), n17)).when(k % 3 == 1, F.concat(F.lit("ks. liite "), n17)).otherwise("Teksti")
    number = (F.col("page_index") + 1 + F.col("doc_id") % 3).cast("string")
    row = lambda seq, kind, text, y, on=None: (F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), text.alias("text"), F.lit(float(y)).alias("y0"), F.lit(y + 15.0).alias("y1")), on)
    none = F.lit(None).cast("string")
    rows = [row(0, "block", _pick(HEADS, k), 100), row(1, "block", second, 150), row(2, "block", _pick(LINES, k), 200), row(3, "block", number, 800), row(4, "table", none, 300, k % 2 == 0), row(5, "table", none, 500, k % 12 == 2)]
    each = F.array_compact(F.array(*[r if on is None else F.when(on, r) for r, on in rows]))
    listed = F.when((F.col("i.seq") == 2) & (k % 9 == 5), "list_item")
    return pages.select("doc_id", "page_index", "k", F.explode(each).alias("i")).select("doc_id", "page_index", "k", "i.*", ((k + F.col("i.seq")) % 2 == 0).alias("bold"), listed.alias("semantic_type"))


def report_cells(spark: SparkSession, sf_dir: str, pages: DataFrame) -> DataFrame:
    """Cells of the pages' tables: order lines on every other page, a balance on those headed so."""
    lines = cells(spark, sf_dir).join(pages.where("k % 2 = 0").select("doc_id", "page_index", F.col("k").alias("table_id")), "table_id")
    lines = lines.select("doc_id", "page_index", F.lit(4).alias("seq"), "row_idx", "col_idx", "cell_seq", "text_raw")
    both = _balance(pages.where("k % 12 = 2").select("doc_id", "page_index", "k", "a"), ["doc_id", "page_index"], "k")
    return lines.unionByName(both.select("doc_id", "page_index", F.lit(5).alias("seq"), "row_idx", "col_idx", "cell_seq", "text_raw"))


def _strings(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


REPORT = f"""{CELLS},
rp AS (SELECT o_custkey AS doc_id, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)::int AS page_index, o_orderkey AS k,
              CASE WHEN o_orderkey % 101 = 0 THEN 0.0::double ELSE 595.0::double END AS width, 842.0::double AS height, round(o_totalprice * 100)::bigint AS a FROM orders),
ri AS (SELECT *, (k + seq) % 2 = 0 AS bold, CASE WHEN seq = 2 AND k % 9 = 5 THEN 'list_item' END AS semantic_type FROM (
  SELECT doc_id, page_index, k, 0 AS seq, 'block' AS kind, {_strings(HEADS)}[k % 12 + 1] AS text, 100.0::double AS y0, 115.0::double AS y1 FROM rp
  UNION ALL SELECT doc_id, page_index, k, 1, 'block', CASE WHEN k % 12 IN (1, 10) THEN (k % 9) || '.1 Tase .... ' || (k % 7 + 1) WHEN k % 12 = 5 THEN (k % 17) || '. Selite'
                   WHEN k % 3 = 0 THEN 'see note ' || (k % 17) WHEN k % 3 = 1 THEN 'ks. liite ' || (k % 17) ELSE 'Teksti' END, 150, 165 FROM rp
  UNION ALL SELECT doc_id, page_index, k, 2, 'block', {_strings(LINES)}[k % 9 + 1], 200, 215 FROM rp
  UNION ALL SELECT doc_id, page_index, k, 3, 'block', (page_index + 1 + doc_id % 3)::varchar, 800, 815 FROM rp
  UNION ALL SELECT doc_id, page_index, k, 4, 'table', NULL, 300, 315 FROM rp WHERE k % 2 = 0
  UNION ALL SELECT doc_id, page_index, k, 5, 'table', NULL, 500, 515 FROM rp WHERE k % 12 = 2)),
rbt AS (SELECT doc_id, page_index, k, a FROM rp WHERE k % 12 = 2),
{_balance_sql("rbc", "rbt", "doc_id, page_index", "k")},
rc AS (SELECT doc_id, page_index, 4 AS seq, row_idx, col_idx, cell_seq, text_raw FROM cells JOIN rp ON table_id = k WHERE k % 2 = 0
       UNION ALL SELECT doc_id, page_index, 5, row_idx, col_idx, cell_seq, text_raw FROM rbc)"""
