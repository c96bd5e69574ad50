"""A document as relations, classified and checked as a whole.

documents: doc_id, pdf. pages: doc_id, page_index, width, height, status, score, repeat_run_max. items: doc_id, page_index,
seq, kind (block or table), text (null for tables), y0, y1, bold, semantic_type. cells: doc_id, page_index, seq of their
table, row_idx, col_idx, cell_seq, text_raw. Every step is keyed by doc_id, so many documents are worked on at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import financial_type, is_blank, note_references
from foliant.operators import contents, elements, qa, quality, tables
from foliant.sources.scratch import saved

PAGE, TABLE = ["doc_id", "page_index"], ["doc_id", "page_index", "seq"]


def with_quality(pages: DataFrame, texts: DataFrame) -> DataFrame:
    """pages with status, score and repeat_run_max of their texts (doc_id, page_index, text); null where a page has none."""
    q = quality.with_quality(texts).select(*PAGE, "status", "score", "repeat_run_max")
    return pages.join(q, PAGE, "left")


def merged(first: DataFrame, second: DataFrame, first_kind: str = "native", second_kind: str = "ocr") -> DataFrame:
    """The items of two sources, per page those of the first source before those of the second: source and seq are set anew."""
    x = first.withColumns({"source": F.lit(first_kind), "_r": F.lit(0)}).unionByName(second.withColumns({"source": F.lit(second_kind), "_r": F.lit(1)}))
    order = Window.partitionBy(*PAGE).orderBy("_r", "seq")
    return x.withColumn("_n", (F.row_number().over(order) - 1).cast("int")).drop("_r", "seq").withColumnRenamed("_n", "seq")


def item_texts(items: DataFrame, cells: DataFrame) -> DataFrame:
    """items with `full` (a table's cells joined), `sample` (the first five cells of its first row), `structure` (what its first ten cells state) and toc_table.

    One grouping of the cells gives all four: a table's cells meet in a row, in order.
    """
    parts = F.array_sort(F.collect_list(F.struct("cell_seq", "row_idx", "text_raw")))
    dots, numbers = F.count_if(F.col("text_raw").rlike(r"\.{2,}")), F.count_if(F.trim("text_raw").rlike(r"^\d{1,3}$"))
    g = cells.groupBy(*TABLE).agg(parts.alias("c"), F.count("*").alias("n"), dots.alias("dotted"), numbers.alias("paged"))
    text = lambda p: p["text_raw"]
    head = F.slice(F.filter("c", lambda p: p["row_idx"] == 0), 1, 5)
    t = g.select(
        *TABLE,
        F.concat_ws(" ", F.transform("c", text)).alias("_full"),
        F.when(F.exists("c", lambda p: p["row_idx"] == 0), F.concat_ws(" ", F.transform(head, text))).alias("_head"),
        tables.stated(F.concat_ws(" ", F.transform(F.slice("c", 1, 10), lambda p: F.lower(p["text_raw"])))).alias("structure"),
        tables.looks_like_contents(F.col("n"), F.col("dotted"), F.col("paged")).alias("_toc"),
    )
    x = items.join(t, TABLE, "left")
    return x.withColumns({"full": F.coalesce("_full", "text", F.lit("")), "sample": F.coalesce("_head", "text", F.lit("")), "toc_table": F.coalesce("_toc", F.lit(False))}).drop("_full", "_head", "_toc")


def first_sections(pages: DataFrame, texts: DataFrame) -> DataFrame:
    """pages (doc_id, page_index) with n_items, full text, section and confidence as their own words say."""
    order = Window.partitionBy(*PAGE).orderBy("seq")
    x = texts.withColumn("_n", F.row_number().over(order))
    joined = lambda c, when: F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("seq", c)))), lambda s: s[c]))
    g = x.groupBy(*PAGE).agg(
        F.count("*").alias("n_items"),
        F.concat(F.lit(" "), joined("full", F.lit(True))).alias("full"),
        joined("sample", F.col("_n") <= 10).alias("sample"),
        F.bool_or("toc_table").alias("toc_table"),
        F.bool_or(F.coalesce(F.col("semantic_type") == "list_item", F.lit(False)) | ((F.col("_n") <= 10) & F.col("sample").contains("..."))).alias("listed"),
    )
    p = pages.select(*PAGE).join(g, PAGE, "left").fillna({"n_items": 0, "full": "", "sample": ""})
    p = contents.contents_pages(p.withColumnRenamed("full", "text")).withColumnsRenamed({"text": "full", "sample": "text"})
    return contents.section(p).select(*PAGE, "n_items", "full", "section", "confidence")


def classified_pages(documents: DataFrame, pages: DataFrame, items: DataFrame, cells: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """doc_id, page_index, section, confidence, offset. texts: item_texts of items and cells, where they are at hand.

    Pages are classified by their words; the contents pages so found point to others; a page that is no contents or
    cover page takes what they say of it, else what strong words say, else keeps its own.
    """
    own = first_sections(pages, item_texts(items, cells) if texts is None else texts).withColumnsRenamed({"full": "text", "section": "own", "confidence": "sure"})
    # strong words are looked for in the same pass, so that the pages' text is not stored again
    own = saved(elements.indicated(own).select(*PAGE, F.col("own").alias("section"), F.col("sure").alias("confidence"), F.col("section").alias("hard"), F.col("confidence").alias("hard_confidence")), "first-sections")
    at = pages.select(*PAGE, "height", (F.row_number().over(Window.partitionBy("doc_id").orderBy("page_index")) - 1).alias("page_no"))
    blocks = items.where("kind = 'block'").join(at, PAGE)
    offsets = contents.page_offsets(documents, blocks, own)
    entries = toc_entries(items, cells, own).where("target >= 0").join(offsets, "doc_id").withColumn("pdf_page", F.col("target") + F.col("offset"))
    targets = entries.where("pdf_page >= 0").groupBy("doc_id", F.col("pdf_page").alias("page_index")).agg(F.max_by("type", F.struct(entries.page_index, "first")).alias("target"))
    x = own.join(targets, PAGE, "left")
    return elements.settled_sections(x).join(offsets, "doc_id", "left").select(*PAGE, "section", "confidence", "offset")


def toc_entries(items: DataFrame, cells: DataFrame, sections: DataFrame) -> DataFrame:
    """Contents entries of the pages whose section is toc: doc_id, page_index, entry, type, target, first."""
    toc = sections.where("section = 'toc'").select(*PAGE)
    lines = items.where("kind = 'block'").select(*PAGE, F.struct("seq", F.lit(0).alias("cell")).alias("at"), "text")
    lines = lines.unionByName(cells.select(*PAGE, F.struct("seq", F.col("cell_seq").cast("int").alias("cell")).alias("at"), F.col("text_raw").alias("text")))
    lines = lines.join(toc, PAGE, "left_semi")
    seq = F.row_number().over(Window.partitionBy(*PAGE).orderBy("at"))
    return contents.entries(lines.withColumn("seq", seq), PAGE)


def classified_items(items: DataFrame, cells: DataFrame, sections: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """doc_id, page_index, seq, kind, semantic_type, financial_type, evidence, toc_target_page, pdf_target_page.

    On contents pages an item takes the type and target of the first entry that it holds; other blocks go by their
    words, tables by their first cells and then by the words of their head.
    """
    texts = item_texts(items, cells) if texts is None else texts
    first = F.row_number().over(Window.partitionBy(*PAGE).orderBy("seq")) == 1
    x = elements.semantic_types(texts.withColumns({"is_first": first, "text": F.coalesce("text", F.lit(""))}))
    found = saved(toc_entries(items, cells, sections), "contents-entries")
    i, e = items.where("kind = 'block'").alias("i"), found.alias("e")
    hit = i.join(e, (F.col("i.doc_id") == F.col("e.doc_id")) & (F.col("i.page_index") == F.col("e.page_index")) & F.lower("i.text").contains(F.lower("e.entry")))
    hit = hit.groupBy("i.doc_id", "i.page_index", "i.seq").agg(F.min_by(F.struct("e.type", "e.target", "e.entry"), "e.first").alias("hit"))
    x = x.join(hit, TABLE, "left").join(sections.select(*PAGE, "offset"), PAGE, "left")
    words = financial_type(F.when(F.col("kind") == "table", F.col("sample")).otherwise(F.col("text")))
    table = F.when(F.col("structure") != "unknown", F.struct(F.col("structure").alias("type"), F.concat(F.lit("structure:"), "structure").alias("evidence")))
    entry = F.when(F.col("hit").isNotNull(), F.struct(F.col("hit.type").alias("type"), F.concat(F.lit("toc_entry:"), "hit.entry").alias("evidence")))
    what = F.when(F.col("kind") == "table", F.coalesce(table, words)).otherwise(F.coalesce(entry, words))
    target = F.when(F.col("hit.target") >= 0, F.col("hit.target"))
    pdf = F.when(target + F.col("offset") >= 0, target + F.col("offset"))
    return x.select(*TABLE, "kind", "semantic_type", what["type"].alias("financial_type"), what["evidence"].alias("evidence"), target.alias("toc_target_page"), pdf.alias("pdf_target_page"))


# ---------------------------------------------------------------- checks


def note_definitions(blocks: DataFrame) -> DataFrame:
    """doc_id and note of blocks (doc_id, text) on notes pages: a number and a full stop at the start, or a note named anywhere."""
    low = F.lower("text")
    found = [F.regexp_extract_all(low, F.lit(p), F.lit(1)) for p in (r"^(\d+)\.", r"liite\s*(\d+)", r"liitetieto\s*(\d+)", r"note\s*(\d+)")]
    return blocks.select("doc_id", F.explode(F.flatten(F.array(*found))).alias("note")).select("doc_id", F.col("note").cast("decimal(38,0)").alias("note")).distinct()


def _say(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _some(values: Column, most: int) -> Column:
    return F.concat_ws(", ", F.transform(F.slice(values, 1, most), lambda v: v.cast("string")))


def _found(df: DataFrame, checker: str, severity, reason: Column, page="page_index", item=None) -> DataFrame:
    """doc_id and the columns of qa.finding."""
    sev = F.lit(severity) if isinstance(severity, str) else severity
    page_ = F.col(page) if isinstance(page, str) else F.lit(0)
    return df.select("doc_id", F.lit(checker).alias("checker"), page_.cast("int").alias("page_index"), (F.lit(None) if item is None else F.col(item)).cast("string").alias("item"), sev.alias("severity"), reason.alias("reason"))


def check_schema(documents: DataFrame, pages: DataFrame) -> DataFrame:
    no_pdf = _found(documents.where("pdf is null"), "schema", "error", F.lit("no PDF metadata"), page=None)
    no_pages = _found(documents.join(pages, "doc_id", "left_anti"), "schema", "error", F.lit("no pages"), page=None)
    flat = pages.where("width <= 0 or height <= 0")
    return no_pdf.unionByName(no_pages).unionByName(_found(flat, "schema", "error", F.lit("page without extent")))


def check_sums(cells: DataFrame) -> DataFrame:
    x = tables.row_totals(cells, TABLE)
    return _found(x, "sums", "warning", _say("row ", F.col("row_idx").cast("string"), " does not add up"), item="seq")


def check_sections(sections: DataFrame) -> DataFrame:
    missing = qa.missing_sections(sections, "doc_id").groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list("missing")), ", ").alias("m"))
    null = sections.where("section is null").groupBy("doc_id").agg(F.array_sort(F.collect_list("page_index")).alias("p"))
    null = null.select("doc_id", F.col("p")[0].alias("page_index"), F.size("p").cast("string").alias("n"), _some(F.col("p"), 10).alias("some"))
    return _found(missing, "sections", "warning", _say("missing: ", F.col("m")), page=None).unionByName(_found(null, "sections", "info", _say(F.col("n"), " pages without a section: ", F.col("some"))))


def check_quality(pages: DataFrame) -> DataFrame:
    """Bad pages with the worst five, and pages with runs of ten or more. Of pages equally bad the earlier comes first."""
    bad = pages.where("status = 'bad'").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("score", "page_index"))).alias("p"))
    bad = bad.select("doc_id", F.col("p")[0]["page_index"].alias("page_index"), _say(F.size("p").cast("string"), " bad pages, worst: ", _some(F.transform("p", lambda x: x["page_index"]), 5)).alias("r"))
    runs = pages.where("repeat_run_max >= 10").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_index", "repeat_run_max"))).alias("p"))
    runs = runs.select("doc_id", F.col("p")[0]["page_index"].alias("page_index"), _say(F.size("p").cast("string"), " noisy pages: ", _some(F.transform("p", lambda x: x["page_index"]), 5)).alias("r"))
    return _found(bad, "quality", "warning", F.col("r")).unionByName(_found(runs, "quality", "warning", F.col("r")))


def check_balance(items: DataFrame, cells: DataFrame) -> DataFrame:
    """Tables whose financial_type is balance_sheet, in items with their types."""
    of = items.where("kind = 'table' and financial_type = 'balance_sheet'").select(*TABLE)
    x = tables.balance(cells.join(of, TABLE, "left_semi"), TABLE).where("severity <> 'ok'")
    return _found(x, "balance", F.col("severity"), F.lit("assets and liabilities differ"), item="seq")


def check_references(items: DataFrame, sections: DataFrame) -> DataFrame:
    """Notes referred to outside notes pages: one warning for each that no notes page has, and a summary; or that there are no notes."""
    b = items.where("kind = 'block'").select(*TABLE, F.coalesce("text", F.lit("")).alias("text")).join(sections.select(*PAGE, "section"), PAGE)
    defined = note_definitions(b.where("section = 'notes'"))
    none = sections.select("doc_id").distinct().join(defined.select("doc_id").distinct(), "doc_id", "left_anti")
    refs = b.where("section is null or section <> 'notes'").select(*TABLE, F.posexplode(note_references(F.col("text"))).alias("k", "note")).withColumn("note", F.col("note").cast("decimal(38,0)"))
    refs = refs.join(defined.select("doc_id").distinct(), "doc_id", "left_semi")
    known = defined.withColumn("known", F.lit(True))
    g = refs.groupBy("doc_id", "note").agg(F.count("*").alias("n"), F.min_by("page_index", F.struct("page_index", "seq", "k")).alias("page_index")).join(known, ["doc_id", "note"], "left")
    missing = _found(g.where("known is null"), "references", "warning", _say("note is missing, mentions: ", F.col("n").cast("string")), item="note")
    s = g.groupBy("doc_id").agg(F.count("*").alias("all"), F.count("known").alias("ok"))
    summary = _found(s, "references", "info", _say(F.col("ok").cast("string"), " of ", F.col("all").cast("string"), " notes found"), page=None)
    return missing.unionByName(summary).unionByName(_found(none, "references", "info", F.lit("no notes, not checked"), page=None))


def counts_by(df: DataFrame, keys: list[str], what: str, default: str | None = None) -> DataFrame:
    """keys, kind and n: how often each value of `what` occurs; nulls count as `default`, or not at all."""
    kind = F.coalesce(what, F.lit(default)) if default else F.col(what)
    return df.select(*keys, kind.alias("kind")).where("kind is not null").groupBy(*keys, "kind").agg(F.count("*").alias("n"))


def distribution_changed(now: DataFrame, before: DataFrame) -> DataFrame:
    """doc_id of those whose counts (doc_id, kind, n) are not the same in both."""
    a, b = now.withColumnRenamed("n", "n_now"), before.withColumnRenamed("n", "n_before")
    return a.join(b, ["doc_id", "kind"], "full").where("not n_now <=> n_before").select("doc_id").distinct()


def check_snapshot(pages: DataFrame, items: DataFrame, old_pages: DataFrame, old_items: DataFrame) -> DataFrame:
    """Against an earlier snapshot of documents that are in both: items per page, financial types, page quality, and a summary."""
    both = pages.select("doc_id").distinct().join(old_pages.select("doc_id").distinct(), "doc_id", "left_semi")
    now, old, i_now, i_old = (x.join(both, "doc_id", "left_semi") for x in (pages, old_pages, items, old_items))
    per = lambda p, i, name: p.select(*PAGE).join(i.groupBy(*PAGE).agg(F.count("*").alias("n")), PAGE, "left").select(*PAGE, F.coalesce("n", F.lit(0)).alias(name))
    d = per(now, i_now, "a").join(per(old, i_old, "b"), PAGE, "full").select(*PAGE, F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b")).where("a <> b")
    change = F.struct("page_index", _say("p", F.col("page_index").cast("string"), ":", F.col("a").cast("string"), ">", F.col("b").cast("string")).alias("t"))
    d = d.groupBy("doc_id").agg(F.array_sort(F.collect_list(change)).alias("c"))
    pages_ = _found(d.select("doc_id", F.col("c")[0]["page_index"].alias("page_index"), _say("items changed on ", F.size("c").cast("string"), " pages: ", _some(F.transform("c", lambda x: x["t"]), 5)).alias("r")), "snapshot", "warning", F.col("r"))
    types = distribution_changed(counts_by(i_now, ["doc_id"], "financial_type"), counts_by(i_old, ["doc_id"], "financial_type"))
    status = distribution_changed(counts_by(now, ["doc_id"], "status", "unknown"), counts_by(old, ["doc_id"], "status", "unknown"))
    n = now.groupBy("doc_id").agg(F.count("*").alias("a")).join(old.groupBy("doc_id").agg(F.count("*").alias("b")), "doc_id").join(d.select("doc_id", F.size("c").alias("c")), "doc_id", "left")
    done = _say(F.col("a").cast("string"), " pages, before ", F.col("b").cast("string"), "; changed ", F.coalesce("c", F.lit(0)).cast("string"))
    lost = pages.select("doc_id").distinct().join(both, "doc_id", "left_anti")
    out = pages_.unionByName(_found(types, "snapshot", "warning", F.lit("financial types changed"), page=None)).unionByName(_found(status, "snapshot", "info", F.lit("page quality changed"), page=None))
    return out.unionByName(_found(n, "snapshot", "info", done, page=None)).unionByName(_found(lost, "snapshot", "info", F.lit("no snapshot, not checked"), page=None))


def reports(documents: DataFrame, cells: DataFrame, found: DataFrame) -> DataFrame:
    """Per document: pdf, schema_valid, the shares of blank cells and of cells with a digit that no number came of (per cent), and its findings in the order of the checkers."""
    n = tables.with_numbers(cells)
    blank = is_blank(F.col("text_raw"))
    c = n.groupBy("doc_id").agg(F.count("*").alias("cells"), F.count_if(blank).alias("blank"), F.count_if(~blank & F.col("text_raw").rlike(r"\d") & F.col("value_num").isNull()).alias("unparsed"))
    each = F.struct("checker_order", "page_index", "item", "checker", "severity", "reason")
    f = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(each)).alias("findings"), F.bool_or(F.col("checker") == "schema").alias("broken"))
    share = lambda k: F.coalesce(F.col(k) * 100.0 / F.col("cells"), F.lit(0.0)).alias(f"{k}_percent")
    x = documents.join(c, "doc_id", "left").join(f, "doc_id", "left")
    none = F.array().cast(f.schema["findings"].dataType)
    return x.select("doc_id", "pdf", (~F.coalesce("broken", F.lit(False))).alias("schema_valid"), share("blank"), share("unparsed"), F.coalesce("findings", none).alias("findings"))


# ---------------------------------------------------------------- summaries


def target_coverage(items: DataFrame) -> DataFrame:
    """Per document how many items have a contents target, a PDF page for it, and a financial type."""
    return items.groupBy("doc_id").agg(F.count("*").alias("items"), F.count("toc_target_page").alias("with_target"), F.count("pdf_target_page").alias("with_pdf_target"), F.count("financial_type").alias("with_type"))


def result_counts(pages: DataFrame, items: DataFrame, sections: DataFrame) -> DataFrame:
    """Per document pages, those with a section and with quality, items, typed ones, and what stands on its contents pages: tables and list items."""
    p = pages.join(sections.select(*PAGE, "section"), PAGE, "left").groupBy("doc_id").agg(F.count("*").alias("pages"), F.count("section").alias("with_section"), F.count("status").alias("with_quality"))
    toc = items.join(sections.where("section = 'toc'").select(*PAGE, F.lit(True).alias("toc")), PAGE, "left")
    is_ = lambda c: F.count_if(F.coalesce("toc", F.lit(False)) & (F.col("semantic_type") == c))
    i = toc.groupBy("doc_id").agg(F.count("*").alias("items"), F.count("financial_type").alias("with_type"), is_("table").alias("toc_tables"), is_("list_item").alias("toc_list_items"))
    return p.join(i, "doc_id", "left").fillna(0, ["items", "with_type", "toc_tables", "toc_list_items"])


def passes_used(items: DataFrame, keys: list[str]) -> DataFrame:
    """keys, items, those with a recognition pass, and those that took more than the first. items: keys, pass (null for none)."""
    return items.groupBy(*keys).agg(F.count("*").alias("items"), F.count("pass").alias("with_pass"), F.count_if(F.col("pass") > 1).alias("several"))
