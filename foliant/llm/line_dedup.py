"""Line deduplication across documents, exact and within one edit.

Equal lines meet by digest. Lines one edit apart meet in a deletion-neighbourhood join: a line emits, as hashed keys,
the variants that arise by deleting one character (and itself, for partners one character shorter or longer); equal
variants join, the edit distance is verified on the texts, and the earlier line stays.

Emitting every variant of every line would shuffle a row per character of the corpus. A lossless filter comes first:
a line is cut into segments, and lines one edit apart agree outside one segment. Only lines that agree so with another
line emit variants, and only those that delete inside that segment. Groups are joined as stars to their earliest line,
never as pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS, small, stored, table, text_of

#: Characters of a segment at most (a line has two at least): the variants of a line cost its length times this.
SEGMENT = 2_048
#: Rows (digests, documents) that may be broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 200_000


def _order() -> Column:
    """Sorts lines by document and place; null ids last."""
    return F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("doc_id"), F.col("text_key").alias("text_key"), F.col("line_no").alias("line_no"))


def _split(text: Column) -> Column:
    """The lines of a text without white space around them. Trimmed inside the array: an expression over an exploded line would be inlined wherever the line is used."""
    return F.transform(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(WS)))


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (tells texts with one doc_id apart), line_no from 0, line (trimmed), digest (null for a blank line)."""
    t = docs.select(F.col("doc_id"), text_of().alias("t"))
    x = t.select("doc_id", F.xxhash64("t").alias("text_key"), F.posexplode(_split(F.col("t"))).alias("line_no", "line"))
    return x.withColumn("digest", F.when(F.col("line") != "", F.unhex(F.md5("line"))))


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """digest, first, line for wanted (digest, first), read from the documents in which those lines come first."""
    by_doc = wanted.groupBy(F.col("first.doc_id").alias("w_id"), F.col("first.text_key").alias("w_key"))
    by_doc = by_doc.agg(F.map_from_entries(F.collect_list(F.struct("first.line_no", "digest"))).alias("want"))
    by_doc = small(stored(by_doc, "wanted"), BROADCAST_ROWS)
    t = docs.select("doc_id", text_of().alias("t"))
    x = t.join(by_doc, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.xxhash64("t") == F.col("w_key")))
    x = x.select("want", F.posexplode(_split(F.col("t"))).alias("line_no", "line"))
    x = x.select(F.try_element_at("want", F.col("line_no")).alias("digest"), "line").where("digest is not null")
    return x.groupBy("digest").agg(F.first("line").alias("line")).join(wanted, "digest")  # a row that is repeated gives its lines again


def _parts(m: Column) -> Column:
    return F.greatest(F.lit(2), (m / SEGMENT).cast("int") + 1)


def _segment_keys() -> Column:
    """Hashes of column line (of length n) without one segment, for partners of its own length or longer (m = n) and shorter (m = n - 1)."""
    n = F.col("n")

    def keys(m: Column) -> Column:
        q = _parts(m)
        lo = lambda i: F.floor(m.cast("long") * i / q).cast("int")
        return F.transform(F.sequence(F.lit(0), q - 1), lambda i: F.struct(F.xxhash64(m, i, F.substring("line", F.lit(1), lo(i)), F.substring("line", n - m + lo(i + 1) + 1, m - lo(i + 1))).alias("key"), m.alias("m"), i.alias("part")))

    return F.when(n > 0, F.concat(keys(n), keys(n - 1)))


def _near(unique: DataFrame, docs: DataFrame) -> DataFrame:
    """digest of each line that has an earlier line within one edit, and the digest of the earliest such line."""
    keyed = unique.select("digest", F.explode("keys").alias("k")).select("digest", "k.*")
    shared = keyed.groupBy("key").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("key")
    match = stored(keyed.join(shared, "key").select("digest", "m", "part"), "matches")
    wanted = stored(match.select("digest").distinct().join(unique.select("digest", "first"), "digest"), "candidates")
    text = stored(_texts_of(docs, wanted), "candidate-lines")
    x = match.join(text, "digest").select("digest", "first", "line", F.col("m"), F.length("line").alias("n"), F.col("part"), _parts(F.col("m")).alias("q"))
    lo = F.floor(F.col("m").cast("long") * F.col("part") / F.col("q")).cast("int")
    hi = F.floor(F.col("m").cast("long") * (F.col("part") + 1) / F.col("q")).cast("int")
    x = x.select("*", (lo + 1).alias("from"), (F.col("n") - (F.col("m") - hi)).alias("to"))
    cut = lambda p: (F.substring("line", F.lit(1), p - 1), F.substring("line", p + 1, F.col("n") - p))
    places = F.sequence(F.col("from"), F.col("to"))
    # partners of equal length: the same place deleted leaves the same rest
    same = x.where("n = m and `from` <= `to`").select("digest", "first", F.explode(F.transform(places, lambda p: F.xxhash64(p, F.concat(*cut(p))))).alias("key"))
    # partners of which one is longer by a character: a deletion gives the other line
    whole = x.where("n = m").select("digest", "first", F.xxhash64("line").alias("key")).distinct()
    less = x.where("n = m + 1 and `from` <= `to`").select("digest", "first", F.explode(F.array_distinct(F.transform(places, lambda p: F.xxhash64(F.concat(*cut(p)))))).alias("key"))
    best = same.groupBy("key").agg(F.min(F.struct("first", "digest")).alias("best"), F.max("digest").alias("hi"), F.min("digest").alias("lo")).where("lo <> hi")
    star = same.join(best.select("key", "best"), "key").where("digest <> best.digest").select(F.col("digest").alias("later"), F.col("best.digest").alias("earlier"))
    w, d = whole.alias("w"), less.alias("d")
    pair = w.join(d, F.col("w.key") == F.col("d.key")).where("w.digest <> d.digest")
    sooner = F.col("w.first") < F.col("d.first")
    pair = pair.select(F.when(sooner, F.col("d.digest")).otherwise(F.col("w.digest")).alias("later"), F.when(sooner, F.col("w.digest")).otherwise(F.col("d.digest")).alias("earlier"))
    link = star.unionByName(pair).distinct()
    a = text.select(F.col("digest").alias("later"), F.col("line").alias("a"), F.col("first").alias("fa"))
    b = text.select(F.col("digest").alias("earlier"), F.col("line").alias("b"), F.col("first").alias("fb"))
    link = link.join(a, "later").join(b, "earlier").where((F.levenshtein("a", "b", 1) == 1) & (F.col("fb") < F.col("fa")))
    return stored(link.groupBy("later").agg(F.min_by("earlier", "fb").alias("near_of")).withColumnRenamed("later", "digest"), "near")


def judged_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, line_no, exact and near: whether an earlier line is equal, or (if none is) within one edit; full: not blank.

    Rows that repeat doc_id and text each have their lines here, and count as one document.
    """
    x = lines(docs).withColumn("n", F.length("line"))  # a column of its own: it is used at every step of the segment keys
    slim = stored(x.select("doc_id", "text_key", "line_no", "digest", _segment_keys().alias("keys")), "lines")
    unique = slim.where("digest is not null").groupBy("digest").agg(F.min(_order()).alias("first"), F.count("*").alias("n"), F.first("keys").alias("keys"))
    unique = stored(unique, "unique")
    near = _near(unique, docs)
    told = unique.join(near, "digest", "left").where("n > 1 or near_of is not null").select("digest", "first", F.col("near_of").isNotNull().alias("is_near"))
    # a blank line has a key of its own, so that blank lines do not meet in one task where the join shuffles
    own = F.coalesce("digest", F.unhex(F.hex(F.xxhash64("doc_id", "text_key", "line_no"))))
    y = slim.drop("keys").withColumn("key", own).join(small(stored(told.withColumnRenamed("digest", "key"), "told"), BROADCAST_ROWS), "key", "left")
    exact = F.col("first").isNotNull() & (_order() != F.col("first"))
    near_ = ~F.coalesce(exact, F.lit(False)) & F.coalesce("is_near", F.lit(False))
    return y.select("doc_id", "text_key", "line_no", F.coalesce(exact, F.lit(False)).alias("exact"), near_.alias("near"), F.col("digest").isNotNull().alias("full"))


def line_report(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_exact, n_near, n_kept, dropped (line numbers from 0, joined by commas).

    Lines are compared without white space around them. Of equal lines the earliest stays, by doc_id (null last), then
    hash of the text, then place. A line of any length also goes when any earlier line is within one edit of it (a
    character replaced, inserted or removed), whether or not that one stays. Blank lines always stay. Null texts count as empty: one blank line. Of rows that repeat both
    doc_id and text the first is judged so, and all others lose every line that is not blank; rows that repeat only the
    doc_id are told apart. An empty table gives an empty result. Columns other than doc_id and text are ignored.
    """
    j = judged_lines(docs).groupBy("doc_id", "text_key", "line_no").agg(F.max("exact").alias("exact"), F.max("near").alias("near"), F.max("full").alias("full"), F.count("*").alias("rows"))
    gone = F.col("exact") | F.col("near")
    n = lambda c: F.sum(c.cast("long"))
    numbers = lambda c: F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.when(c, F.col("line_no")))), lambda p: p.cast("string")))
    first = F.struct(n(F.col("exact")).alias("n_exact"), n(F.col("near")).alias("n_near"), n(~gone).alias("n_kept"), numbers(gone).alias("dropped"))
    other = F.struct(n(F.col("full")).alias("n_exact"), F.lit(0).cast("long").alias("n_near"), n(~F.col("full")).alias("n_kept"), numbers(F.col("full")).alias("dropped"))
    out = j.groupBy("doc_id", "text_key").agg(F.count("*").alias("n_lines"), F.max("rows").alias("rows"), first.alias("first"), other.alias("other"))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("k")
    return out.select("doc_id", "n_lines", "first", "other", each).select("doc_id", "n_lines", F.inline(F.array(F.when(F.col("k") == 1, F.col("first")).otherwise(F.col("other")))))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs without the lines that line_report drops; a document that loses its last line with text goes as a whole.

    So of rows that repeat doc_id and text (with text in it) one stays, the first by all columns; rows whose text is
    null, empty or blank all stay. All columns stay; n_chars, where there is one, is counted again.
    """
    lines_ = judged_lines(docs).groupBy("doc_id", "text_key", "line_no").agg((F.max("exact") | F.max("near")).alias("out"), F.max("full").alias("full"), F.count("*").alias("rows"))
    gone = lines_.groupBy("doc_id", "text_key").agg(F.collect_list(F.when(F.col("out"), F.col("line_no"))).alias("gone"), ((F.max("rows") > 1) & F.max("full")).alias("again"))
    gone = gone.where("again or size(gone) > 0")
    gone = small(stored(gone.withColumnsRenamed({"doc_id": "gone_id", "text_key": "gone_key"}), "dropped"), BROADCAST_ROWS)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    key = F.xxhash64(F.coalesce("row.text", F.lit("")))
    x = row.withColumn("text_key", key).join(gone, F.col("row.doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_key") == F.col("gone_key")), "left")
    left = F.filter(F.split("row.text", "\n", -1), lambda _, i: ~F.array_contains("gone", i))
    whole = F.coalesce(F.size("gone"), F.lit(0)) <= 0
    x = x.withColumn("new", F.when(whole, F.col("row.text")).otherwise(F.array_join(left, "\n")))
    x = x.where(whole | (F.trim("new", F.lit(WS)) != ""))
    put = {"text": F.col("new"), "n_chars": F.length("new").cast("long")}
    out = F.struct(*[(F.when(whole, F.col(f"row.`{c}`")).otherwise(put[c]) if c in put else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
    x = x.select(F.coalesce("again", F.lit(False)).alias("again"), "gone_id", "gone_key", out.alias("row"))
    one = x.where("again").groupBy("gone_id", "gone_key").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return x.where("not again").select("row.*").unionByName(one.select("row.*"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


#: Line decisions over a CTE `src` (doc_id, text), as ln (doc_id, tk, no, exact, near).
ORACLE_PARTS = r"""
ls AS (SELECT doc_id, rid, generate_subscripts(a, 1) - 1 AS no, trim(unnest(a), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS l
       FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id, text) AS rid, string_split(coalesce(text, ''), chr(10)) AS a FROM src)),
un AS (SELECT l, length(l) AS n, row_number() OVER (ORDER BY min((doc_id, rid, no))) AS pos, min((doc_id, rid, no)) AS f FROM ls WHERE l <> '' GROUP BY l),
hv AS (SELECT l, n, pos, m, left(l, m // 2) AS a, right(l, m - m // 2) AS b FROM un, LATERAL (SELECT unnest([n, n - 1]) AS m)),
cp AS (SELECT DISTINCT x.l AS s, y.l AS t, x.pos AS p, y.pos AS r
       FROM hv x JOIN hv y ON x.m = y.m AND x.a = y.a AND x.n = x.m AND x.l <> y.l
       UNION SELECT DISTINCT x.l, y.l, x.pos, y.pos FROM hv x JOIN hv y ON x.m = y.m AND x.b = y.b AND x.n = x.m AND x.l <> y.l),
df AS (SELECT *, coalesce(list_filter(range(1, length(s) + 1), lambda i: s[i] <> t[i])[1], length(s) + 1) AS i FROM cp),
ok AS (SELECT * FROM df WHERE CASE WHEN length(s) = length(t) THEN s[i + 1:] = t[i + 1:] ELSE s[i:] = t[i + 1:] END),
nr AS (SELECT DISTINCT CASE WHEN p < r THEN t ELSE s END AS l FROM ok),
ln AS (SELECT ls.doc_id, ls.rid, ls.no, coalesce((ls.doc_id, ls.rid, ls.no) <> un.f, false) AS exact,
              coalesce((ls.doc_id, ls.rid, ls.no) = un.f, false) AND nr.l IS NOT NULL AS near
       FROM ls LEFT JOIN un USING (l) LEFT JOIN nr USING (l))"""
ORACLE = f"""WITH src AS (SELECT doc_id, text FROM documents), {ORACLE_PARTS}
SELECT doc_id, count(*) AS n_lines, sum(exact::bigint)::bigint AS n_exact, sum(near::bigint)::bigint AS n_near,
       sum((NOT exact AND NOT near)::bigint)::bigint AS n_kept,
       coalesce(string_agg(CASE WHEN exact OR near THEN no::varchar END, ',' ORDER BY no), '') AS dropped
FROM ln GROUP BY doc_id, rid
"""
