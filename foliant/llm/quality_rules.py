"""Document quality rules whose cut-offs adapt to language and source.

Every document gets integer measurements, and a rate for each rule: occurrences in a million places. A document with one
occurrence more is as likely as the one seen, so the sketches count the rate that it would have then; a source without any
occurrence so has a spread, that of its lengths. Rates fall into bins of a sixteenth of a power of two: a quantile sketch
of bounded size and relative error, whose merge is addition. The sketch of a (language, source) is merged with those of
the language and of all documents, each with the weight of PRIOR documents, so that small groups lean on larger ones
and none is cut off by size. A rate beyond the upper quartile by more than SPREAD quartile ranges is out of bounds;
documents with such a rate are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WS_CLASS, small, stored, table, text_of

SYMBOLS = "#*$%&|<>"
#: Rates, and the fewest places that an occurrence takes: two windows of three words repeat in six words.
RULES = {"symbol": 1, "bang": 1, "upper": 1, "dup_line": 1, "repeat": 6}
#: Cut-off = third quartile + SPREAD * (third - first quartile).
SPREAD = 4
#: Weight, in documents, of the language's sketch and of that of all documents in the sketch of each source.
PRIOR = 50
MIN_WORDS = 50
#: (language, source) groups whose thresholds may be broadcast; beyond it the join shuffles.
BROADCAST_GROUPS = 100_000
#: Dropped documents whose keys may be broadcast to the reading of the texts.
BROADCAST_DOCS = 300_000


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns out of a generator: computed once, where a projection would be inlined at each of their uses, filters included."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def _twins(ordered: Column) -> Column:
    """Places, in order, of the 3-word windows that occur twice or more; ordered holds (window, place) sorted."""
    twin = lambda x, k: (F.get(ordered, k - 1)["w"] == x["w"]) | (F.get(ordered, k + 1)["w"] == x["w"])
    return F.array_sort(F.transform(F.filter(ordered, lambda x, k: F.coalesce(twin(x, k), F.lit(False))), lambda x: x["i"]))


def bin_of(rate: Column) -> Column:
    """Bin of a whole rate: its own below 32, then sixteen to a power of two."""
    shift = F.greatest(F.length(F.bin(rate)) - 5, F.lit(0))
    return F.when(rate < 32, rate.cast("int")).otherwise((shift * 16 + rate / F.pow(F.lit(2.0), shift)).cast("int"))


def edge_of(bin_: Column) -> Column:
    """Smallest rate of a bin."""
    shift = F.greatest(F.floor(bin_ / 16) - 1, F.lit(0))
    return ((bin_ - shift * 16) * F.pow(F.lit(2.0), shift)).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the structs `rates` and `bins`.

    Works row by row on the whole text; other columns stay, under names of their own. Windows of words are told apart
    by 64-bit hashes.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns]
    s = docs.select(F.struct(*keep).alias("row"), text_of().alias("t"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(f"[^{WS_CLASS}]"))
    s = _once(s, words=F.array_remove(F.split("t", f"[{WS_CLASS}]+"), ""), lines=lines)
    windows = F.transform(F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    s = _once(s, windows=windows)
    pairs = F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    none = F.array().cast("array<struct<w:bigint,i:int>>")
    s = _once(s, ordered=F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(pairs)).otherwise(none))
    s = _once(s, twins=_twins(F.col("ordered")))
    covered = F.aggregate(F.transform("twins", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("twins", k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    s = s.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.regexp_count("t", F.lit("!")).cast("long").alias("n_bangs"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.size("lines").cast("long").alias("n_lines"),
    )
    of = dict(zip(RULES, (("n_symbols", "word_chars"), ("n_bangs", "word_chars"), ("n_upper", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words")), strict=True))
    rate = lambda a, b, more: F.expr(f"({a} + {more}) * 1000000 div greatest({b} + {more}, 1)")
    counts = [c for c in s.columns if c != "row"]
    s = s.select("row", F.inline(F.array(F.struct(*[F.col(c) for c in counts]))))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    rates, bins = (F.struct(*[f(rate(*of[k], e * more)).alias(k) for k, e in RULES.items()]) for f, more in ((lambda c: c, 0), (bin_of, 1)))
    return s.withColumns({"base_failed": failed, "rates": rates, "bins": bins})


def sketches(bins: DataFrame) -> DataFrame:
    """bins: lang, source and the struct bins. Returns lang, source, rule, bin, n; merge two of them by adding n."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(f"bins.{k}").alias("bin")) for k in RULES]))
    return bins.select("lang", "source", each.alias("x")).groupBy("lang", "source", "x.rule", "x.bin").agg(F.count("*").alias("n"))


def _shares(sketch: DataFrame, keys: list[str], weight: int) -> DataFrame:
    """keys, rule, bin, w: the sketches of coarser groups, each with the weight of `weight` documents (in millionths)."""
    merged = sketch.groupBy(*keys, "rule", "bin").agg(F.sum("n").alias("n"))
    size = F.sum("n").over(Window.partitionBy(*keys, "rule"))
    return merged.withColumn("size", size).selectExpr(*keys, "rule", "bin", f"{weight} * (n * 1000000 div size) AS w")


def thresholds(bins: DataFrame, spread: int = SPREAD, prior: int = PRIOR) -> DataFrame:
    """One row per (lang, source): a struct `limit` with the cut-off of each rule, from the merged sketches."""
    sketch = stored(sketches(bins), "sketches")
    groups = sketch.select("lang", "source", "rule").distinct()
    lang, whole = _shares(sketch, ["lang"], prior), _shares(sketch, [], prior)
    own = sketch.selectExpr("lang", "source", "rule", "bin", "n * 1000000 AS w")
    g, l = groups.alias("g"), lang.alias("l")
    leans = g.join(l, F.col("g.lang").eqNullSafe(F.col("l.lang")) & (F.col("g.rule") == F.col("l.rule"))).select("g.lang", "g.source", "g.rule", "l.bin", "l.w")
    on_all = groups.join(F.broadcast(whole), "rule").select("lang", "source", "rule", "bin", "w")  # some hundred bins a rule
    merged = own.unionByName(leans).unionByName(on_all).groupBy("lang", "source", "rule", "bin").agg(F.sum("w").alias("w"))
    group = Window.partitionBy("lang", "source", "rule")
    cum = merged.select("*", F.sum("w").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("w").over(group).alias("all"))
    q = lambda part: edge_of(F.min(F.when(F.col("upto") * 4 >= F.col("all") * part, F.col("bin"))))
    x = cum.groupBy("lang", "source", "rule").agg(q(1).alias("q1"), q(3).alias("q3"))
    cut = F.col("q3") + spread * (F.col("q3") - F.col("q1"))
    limit = F.struct(*[F.max(F.when(F.col("rule") == k, cut)).alias(k) for k in RULES])
    return x.groupBy("lang", "source").agg(limit.alias("limit"))


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """rows (lang, source, base_failed, rates, ...) with kept; limits are joined on language and source, nulls equal."""
    x = rows.alias("r").join(small(limits, BROADCAST_GROUPS).alias("l"), F.col("r.lang").eqNullSafe(F.col("l.lang")) & F.col("r.source").eqNullSafe(F.col("l.source")), "left")
    over = F.lit(False)
    for k in RULES:
        over = over | F.coalesce(F.col(f"r.rates.{k}") > F.col(f"l.limit.{k}"), F.lit(False))
    return x.select("r.*", (~F.col("r.base_failed") & ~over).alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    Null text counts as empty, and fails for having fewer than 50 words. Null languages and sources form groups of
    their own. Repeated rows are judged one by one. An empty table gives an empty result. Columns other than doc_id,
    text, lang and source are ignored, whatever their names.
    """
    m = measured(docs.select("doc_id", "text", "lang", "source"))
    slim = stored(m.select("row.doc_id", "row.lang", "row.source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rates", "bins"), "measures")
    return judged(slim, stored(thresholds(slim), "thresholds")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def filter_quality(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns.

    Texts are measured once. What is dropped is then looked up by doc_id, hash of the text, language and source, which
    rows with the same verdict share: nulls and repeated rows included. An empty table gives an empty result.
    """
    m = measured(docs.select("doc_id", "text", "lang", "source"))
    slim = stored(m.select("row.doc_id", F.xxhash64(F.coalesce("row.text", F.lit(""))).alias("text_key"), "row.lang", "row.source", "base_failed", "rates", "bins"), "measures")
    gone = judged(slim, stored(thresholds(slim), "thresholds")).where("not kept").select(*[F.col(c).alias(f"gone_{c}") for c in ("doc_id", "text_key", "lang", "source")])
    gone = small(stored(gone.distinct(), "gone"), BROADCAST_DOCS)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    x = row.withColumn("text_key", F.xxhash64(F.coalesce("row.text", F.lit(""))))
    same = F.col("row.doc_id").eqNullSafe(F.col("gone_doc_id")) & (F.col("text_key") == F.col("gone_text_key")) & F.col("row.lang").eqNullSafe(F.col("gone_lang")) & F.col("row.source").eqNullSafe(F.col("gone_source"))
    return x.join(gone, same, "left_anti").select("row.*")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


#: Measurements and verdicts of a view or CTE `src` (doc_id, text, lang, source).
ORACLE_PARTS = r"""
a AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM src),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM a WHERE len(w) >= 3)),
c AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM g) WHERE n >= 2),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM c) GROUP BY rid),
m AS (SELECT a.rid, doc_id, lang, source, len(w)::bigint AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint AS word_chars,
             (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::bigint AS n_dup_lines, coalesce(r.n, 0)::bigint AS n_repeat_words,
             (length(t) - length(replace(t, '!', '')))::bigint AS n_bangs, (length(t) - length(regexp_replace(t, '\p{Lu}+', '', 'g')))::bigint AS n_upper, len(ls)::bigint AS n_lines
      FROM a LEFT JOIN r ON a.rid = r.rid),
x AS (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
             [n_symbols, n_bangs, n_upper, n_dup_lines, n_repeat_words] AS v, [word_chars, word_chars, word_chars, n_lines, n_words] AS w FROM m),
v AS (SELECT *, v[rule] * 1000000 // greatest(w[rule], 1) AS rate, (v[rule] + e[rule]) * 1000000 // greatest(w[rule] + e[rule], 1) AS more
      FROM (SELECT *, [1, 1, 1, 1, 6] AS e, unnest(range(1, 6)) AS rule FROM x)),
k AS (SELECT lang, source, rule, CASE WHEN more < 32 THEN more ELSE (length(bin(more)) - 5) * 16 + (more >> (length(bin(more)) - 5)) END AS bin, count(*) AS n FROM v GROUP BY ALL),
gr AS (SELECT DISTINCT lang, source, rule FROM k),
kl AS (SELECT lang, rule, bin, 50 * (n * 1000000 // sum(n) OVER (PARTITION BY lang, rule)) AS w FROM (SELECT lang, rule, bin, sum(n)::bigint AS n FROM k GROUP BY ALL)),
kw AS (SELECT rule, bin, 50 * (n * 1000000 // sum(n) OVER (PARTITION BY rule)) AS w FROM (SELECT rule, bin, sum(n)::bigint AS n FROM k GROUP BY ALL)),
km AS (SELECT lang, source, rule, bin, sum(w) AS w FROM (
         SELECT lang, source, rule, bin, n * 1000000 AS w FROM k
         UNION ALL SELECT gr.lang, source, gr.rule, bin, w FROM gr JOIN kl ON gr.rule = kl.rule AND gr.lang IS NOT DISTINCT FROM kl.lang
         UNION ALL SELECT lang, source, gr.rule, bin, w FROM gr JOIN kw ON gr.rule = kw.rule) GROUP BY ALL),
kq AS (SELECT lang, source, rule, min(CASE WHEN upto * 4 >= total THEN bin END) AS b1, min(CASE WHEN upto * 4 >= total * 3 THEN bin END) AS b3
       FROM (SELECT *, sum(w) OVER (PARTITION BY lang, source, rule ORDER BY bin) AS upto, sum(w) OVER (PARTITION BY lang, source, rule) AS total FROM km) GROUP BY ALL),
kc AS (SELECT lang, source, rule, q3 + 4 * (q3 - q1) AS cut
       FROM (SELECT *, CASE WHEN b1 < 32 THEN b1 ELSE (b1 - (b1 // 16 - 1) * 16) << (b1 // 16 - 1)::int END AS q1, CASE WHEN b3 < 32 THEN b3 ELSE (b3 - (b3 // 16 - 1) * 16) << (b3 // 16 - 1)::int END AS q3 FROM kq)),
y AS (SELECT v.rid, NOT any_value(base_failed) AND NOT bool_or(rate > cut) AS kept
      FROM v JOIN kc ON v.rule = kc.rule AND v.lang IS NOT DISTINCT FROM kc.lang AND v.source IS NOT DISTINCT FROM kc.source GROUP BY v.rid)"""
ORACLE = f"""WITH src AS (SELECT * FROM documents), {ORACLE_PARTS}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM x JOIN y USING (rid)
"""
