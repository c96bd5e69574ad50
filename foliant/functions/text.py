"""Scalar text functions as Column expressions: no Python code runs on executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyword lists, in the order in which they are tried.
BALANCE = ("tase", "balance sheet", "statement of financial position", "vastaavaa", "vastattavaa", "omavaraisuusaste", "varat", "velat")
INCOME = ("tuloslaskelma", "income statement", "profit or loss", "toimintatuotot", "toimintakulut", "verotulot", "tulos")
CASH = ("rahoituslaskelma", "cash flow", "rahavirtalaskelma", "cash_assets")
NOTES = ("liitetiedot", "notes", "liite", "selitykset", "explanatory notes")
POLICIES = ("tilinpäätöksen laatimisperiaatteet", "accounting policies", "financial_statement_principles")
#: Financial type -> keywords, by priority.
FINANCIAL = {"balance_sheet": BALANCE, "income_statement": INCOME, "cash_flow_statement": CASH, "notes": NOTES, "accounting_policies": POLICIES}

_WORD = "[a-zäöå]"
#: White space that is stripped from cells.
SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u2002\u2003\u2007\u2009\u202f\u3000"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | c.rlike(r"(?U)^\s*$")


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def longest_run(c: Column) -> Column:
    """Length of the longest run of one character; 0 for an empty text. Only runs of two or more are extracted."""
    runs = F.transform(F.regexp_extract_all(c, F.lit(r"(?s)(.)\1+"), F.lit(0)), F.length)
    return F.coalesce(F.array_max(runs), F.least(F.length(c), F.lit(1)))


def bare(text: Column) -> Column:
    """The characters that count: all but spaces and line feeds."""
    return F.translate(F.coalesce(text, F.lit("")), " \n", "")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\S+"), F.lit(0))


def status_counts(c: str, text: Column) -> Column:
    """The integers that decide whether a text is bad, from the column of its bare characters."""
    letters, digits = F.length(F.regexp_replace(c, r"\P{L}+", "")), F.length(F.regexp_replace(c, r"\P{Nd}+", ""))
    return F.struct(F.length(c).alias("chars"), letters.alias("alpha"), digits.alias("digits"), longest_run(F.col(c)).alias("run"), is_blank(text).alias("blank"))


def quality_counts(c: str, tok: str, text: Column) -> Column:
    """The integers that quality is made of, from the columns of a text's bare characters and of its tokens."""
    s = status_counts(c, text)
    first = lambda x: F.substring(x, 1, 1)
    words = F.filter(tok, lambda x: first(x).between("a", "z") | first(x).isin("ä", "ö", "å"))
    # length decides most tokens before any pattern is tried
    junk = F.filter(tok, lambda x: (F.length(x) <= 3) & ~x.rlike(f"^(?:{_WORD}+|\\p{{Nd}}+)$"))
    return F.struct(s["chars"].alias("chars"), s["alpha"].alias("alpha"), s["digits"].alias("digits"), s["run"].alias("run"), s["blank"].alias("blank"), F.size(tok).alias("tokens"), F.size(words).alias("words"), F.length(F.array_join(words, "")).alias("word_chars"), F.size(junk).alias("junk"))


def is_bad(q: str) -> Column:
    """The noise gate, from a column of counts: a long run, or few letters and digits."""
    at = lambda n: F.col(f"{q}.{n}")
    return (at("run") >= 10) | ((ratio(at("alpha"), at("chars")) < 0.30) & (ratio(at("digits"), at("chars")) < 0.05))


def quality(q: str) -> dict[str, Column]:
    """Ratios, score and status from a column of quality_counts. Status is decided on unrounded values."""
    at = lambda n: F.col(f"{q}.{n}")
    blank = at("blank")
    unless = lambda c: F.when(blank, F.lit(0.0)).otherwise(c)
    alpha, digit, junk, word = ratio(at("alpha"), at("chars")), ratio(at("digits"), at("chars")), ratio(at("junk"), at("tokens")), ratio(at("word_chars"), at("words"))
    one = F.lit(1.0)
    score = F.lit(0.4) * alpha + F.lit(0.3) * (one - F.least(junk, one)) + F.lit(0.2) * (one - F.least(at("run") / F.lit(20.0), one)) + F.lit(0.1) * F.least(word / F.lit(10.0), one)
    bad = is_bad(q)
    status = F.when(blank, "empty").when(bad, "bad").when(score < 0.5, "poor").when(score < 0.7, "fair").otherwise("good")
    return {"alpha_ratio": unless(alpha), "digit_ratio": unless(digit), "repeat_run_max": F.when(blank, F.lit(0)).otherwise(at("run")), "junk_token_ratio": unless(junk), "avg_word_len": unless(word), "status": status, "score": unless(score), "noisy": ~blank & bad}


def _number(c: Column) -> Column:
    """The first number of a stripped text without spaces and units; brackets around all of it change its sign."""
    bracketed = c.startswith("(") & c.endswith(")")
    value = F.nullif(F.regexp_extract(F.when(bracketed, F.translate(c, "()", "")).otherwise(c), r"-?\d+\.?\d*", 0), F.lit("")).try_cast("double")
    return F.when(bracketed, -value).otherwise(value)


def normalize_number(text: Column, strict: bool = False) -> Column:
    """struct(value, unit) of a cell. A comma is a decimal point, so "1.234,56" is 1.234.

    The euro sign is looked for before "t€", so thousands of euros carry the unit "€"; strict=True tells them apart.
    Cells are many and short: characters are translated rather than matched.
    """
    unit = F.when(text.contains("€"), "€").when(text.contains("%"), "%")
    bare = F.translate(F.trim(text, F.lit(SPACE)), ", €%", ".")
    if strict:
        unit = F.when(text.contains("t€"), "t€").otherwise(unit)
    full = F.trim(text, F.lit(SPACE)) != ""
    return F.struct(F.when(full, _number(bare)).alias("value"), F.when(full, unit).alias("unit"))


def parse_number(text: Column) -> Column:
    return normalize_number(text)["value"]


def normalize_text(text: Column) -> Column:
    """Spaces collapsed, then soft hyphens removed, then blank lines limited to one, then stripped."""
    c = F.regexp_replace(F.regexp_replace(text, " +", " "), "­", "")
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def toc_target_page(text: Column) -> Column:
    """The page a contents line points to: the first of three readings that lies within 1 to 500."""
    c = strip(text)
    reads = [F.regexp_extract(c, p, 1).try_cast("int") for p in (r"\.{2,}\s*(\d{1,3})\s*$", r"\s+(\d{1,3})\s*$", r"(\d{1,3})\s*$")]
    return F.coalesce(*[F.when(r.between(1, 500), r) for r in reads])


def financial_type(text: Column) -> Column:
    """struct(type, evidence): the first keyword found, by priority of types."""
    low, out = F.lower(text), F.lit(None).cast("struct<type:string,evidence:string>")
    for kind, words in reversed(FINANCIAL.items()):
        for w in reversed(words):
            out = F.when(low.contains(w), F.struct(F.lit(kind).alias("type"), F.lit(f"keyword:{w}").alias("evidence"))).otherwise(out)
    return out


def note_references(text: Column) -> Column:
    """Numbers of all notes referred to. The patterns overlap on purpose: "see note 3" counts twice."""
    low = F.lower(text)
    found = [F.regexp_extract_all(low, F.lit(p), F.lit(1)) for p in (r"liite\s*(\d+)", r"liitetieto\s*(\d+)", r"ks\.\s*liite\s*(\d+)", r"note\s*(\d+)", r"see\s+note\s*(\d+)")]
    return F.flatten(F.array(*found))


def characters(text: Column) -> Column:
    """The characters of a text. Indexing this array costs the same everywhere, unlike substring in UTF-8."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def trigrams(chars: str) -> Column:
    """All runs of three, from a column of characters."""
    c = F.col(chars)
    return F.transform(F.slice(c, 1, F.greatest(F.size(c) - 2, F.lit(0))), lambda x, i: F.concat(x, F.get(c, i + 1), F.get(c, i + 2)))
