"""Sinks. All overwrite: running a job again leaves the same files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.loc import BINARY, EXCLUDED_DIRS, EXCLUDED_PATTERNS


def write_json(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Manifest, blocks, tables, regions or quality as JSON lines, one folder per value of `by`."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*by) if by else w).json(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """A golden snapshot to compare later runs with."""
    df.write.mode("overwrite").parquet(path)


def read_snapshot(like: DataFrame, path: str) -> DataFrame:
    """An earlier snapshot with the columns of `like`; empty where there is none yet."""
    spark = like.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(like.schema).parquet(path) if there else like.limit(0)


def documents_json(pages: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document with its pages and their items nested, in order; pages without items have an empty list."""
    inner = F.array_sort(F.collect_list(F.struct("seq", *[c for c in items.columns if c not in ("doc_id", "page_index", "seq")])))
    by_page = items.groupBy("doc_id", "page_index").agg(inner.alias("items"))
    x = pages.join(by_page, ["doc_id", "page_index"], "left").withColumn("items", F.coalesce("items", F.array().cast(by_page.schema["items"].dataType)))
    page = F.struct("page_index", *[c for c in x.columns if c not in ("doc_id", "page_index")])
    return x.groupBy("doc_id").agg(F.array_sort(F.collect_list(page)).alias("pages"), F.sum(F.size("items")).alias("n_items"))


def not_empty(documents: DataFrame) -> DataFrame:
    """Fails the job on a document without items, before anything is written."""
    return documents.withColumn("n_items", F.when(F.col("n_items") > 0, F.col("n_items")).otherwise(F.raise_error(F.concat(F.lit("no items in document "), F.col("doc_id").cast("string"))).cast("long")))


def read_documents(spark: SparkSession, path: str, schema: str | None = None, many_lines: bool = False) -> DataFrame:
    """Documents that `write_json(documents_json(...))` wrote; many_lines: single JSON documents that are written over several lines."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("multiLine", many_lines).json(path)


def unnested(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pages and the items of documents read back: what documents_json nested."""
    pages = documents.select("doc_id", F.explode("pages").alias("p")).select("doc_id", "p.*")
    return pages.drop("items"), pages.select("doc_id", "page_index", F.explode("items").alias("i")).select("doc_id", "page_index", "i.*")


def write_documents(documents: DataFrame, reports: DataFrame, path: str) -> None:
    """document and qa_report folders; fails on a document without items before anything is written."""
    not_empty(documents).write.format("noop").mode("overwrite").save()
    write_json(documents, f"{path}/document")
    write_json(reports, f"{path}/qa_report")


def _cell(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"\|", r"\\|")


def tables_markdown(grid: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A Markdown table per table from grid rows (keys, row_idx, cells); the first row is the head."""
    keys = keys or ["table_id"]
    line = F.concat(F.lit("| "), F.array_join(F.transform("cells", _cell), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.size("cells")))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("row_idx", line.alias("line")))), lambda x: x["line"])
    g = grid.groupBy(*keys).agg(lines.alias("l"), F.first(rule).alias("rule"))
    return g.select(*keys, F.concat_ws("\n", F.slice("l", 1, 1), F.array("rule"), F.slice("l", 2, F.greatest(F.size("l") - 1, F.lit(0)))).alias("markdown"))


def pages_markdown(items: DataFrame, tables: DataFrame | None = None, sections: DataFrame | None = None) -> DataFrame:
    """Markdown per document: a heading for each page with its section, titles and section headers as headings, tables, and an anchor after each item.

    items: doc_id, page_index, seq, kind (title, section_header, table, other), text. tables: doc_id, page_index, seq,
    markdown; a table without one, or without cells, is left out. sections: doc_id, page_index, section; pages without items have
    a heading all the same.
    """
    if tables is not None:
        items = items.join(tables, ["doc_id", "page_index", "seq"], "left").withColumn("text", F.when(F.col("kind") == "table", F.col("markdown")).otherwise(F.col("text")))
        items = items.where("kind <> 'table' or text is not null")
    body = F.when(F.col("kind") == "title", F.concat(F.lit("### "), F.col("text"))).when(F.col("kind") == "section_header", F.concat(F.lit("#### "), F.col("text"))).when(F.col("kind") == "table", F.concat("text", F.lit("\n"))).otherwise(F.col("text"))
    anchor = F.concat(F.lit("*[#p"), F.col("page_index").cast("string"), F.when(F.col("kind") == "table", "_t").otherwise("_b"), F.col("seq").cast("string"), F.lit("]*\n"))
    number = (F.col("page_index") + 1).cast("string")
    x = items.select("doc_id", "page_index", F.col("seq").cast("long").alias("seq"), F.concat_ws("\n", body, anchor).alias("line"))
    pages = items.select("doc_id", "page_index").distinct().withColumn("section", F.lit(None).cast("string")) if sections is None else sections.select("doc_id", "page_index", "section")
    head = F.concat_ws("", F.lit("## Page "), number, F.lit("\n"), F.when(F.col("section").isNotNull(), F.concat(F.lit("\n*Section: "), "section", F.lit("*\n"))))
    heads = pages.select("doc_id", "page_index", F.lit(-1).cast("long").alias("seq"), head.alias("line"))
    ends = pages.select("doc_id", "page_index", F.lit(1 << 62).alias("seq"), F.lit("---\n").alias("line"))
    lines = F.array_sort(F.collect_list(F.struct("page_index", "seq", "line")))
    return x.unionByName(heads).unionByName(ends).groupBy("doc_id").agg(F.concat_ws("\n", F.transform(lines, lambda v: v["line"])).alias("markdown"))


def sheets_markdown(pieces: DataFrame, blocks: DataFrame, findings: DataFrame) -> DataFrame:
    """Markdown per piece of music: metadata, markings, recognition, findings and text.

    pieces: piece_id, title, composer, dedication, tempo, time_signature, key_signature, copyright, measure_count, dynamics,
    expressions, staff_count, confidence, omr_engine, note_count, status. blocks: piece_id, seq, class, text. findings:
    piece_id, check, severity. What is null or empty is left out.
    """
    named = [("Title", "title"), ("Composer", "composer"), ("Dedication", "dedication"), ("Tempo", "tempo"), ("Time Signature", "time_signature"), ("Key Signature", "key_signature"), ("Copyright", "copyright"), ("Measures", "measure_count")]
    full = lambda c: F.col(c).isNotNull() & ~F.col(c).cast("string").isin("", "0")
    fields = [F.when(full(c), F.concat(F.lit(f"- **{n}**: "), F.col(c).cast("string"))) for n, c in named]
    lists = [F.when(full(c), F.concat(F.lit(f"\n## {n}\n"), F.col(c))) for n, c in (("Dynamic Markings", "dynamics"), ("Expression Markings", "expressions"))]
    b = blocks.groupBy("piece_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "class", "text"))), lambda x: F.concat(F.lit("- ["), x["class"], F.lit("] "), x["text"])), "\n").alias("blocks"))
    f = findings.groupBy("piece_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("check", "severity"))), lambda x: F.concat(F.lit("- ["), F.upper(x["severity"]), F.lit("] "), x["check"])), "\n").alias("findings"))
    head = F.concat(F.lit("# Music Sheet Analysis\n\n**Confidence**: "), F.round(F.col("confidence") * 100).cast("int").cast("string"), F.lit("%\n**Staff Systems**: "), F.col("staff_count").cast("string"), F.lit("\n\n## Metadata"))
    omr = F.concat(F.lit("\n## Recognition\n- **Engine**: "), F.coalesce("omr_engine", F.lit("none")), F.lit("\n- **Measures**: "), F.coalesce(F.col("measure_count").cast("string"), F.lit("0")), F.lit("\n- **Notes**: "), F.coalesce(F.col("note_count").cast("string"), F.lit("0")))
    x = pieces.join(b, "piece_id", "left").join(f, "piece_id", "left")
    text = F.concat_ws("\n", head, *fields, *lists, omr, F.concat(F.lit("\n## Checks\n**Status**: "), F.upper("status")), F.col("findings"), F.lit("\n## Extracted Text Blocks"), F.col("blocks"))
    return x.select("piece_id", text.alias("markdown"))


def write_sheets(pieces: DataFrame, markdown: DataFrame, scores: DataFrame, path: str) -> None:
    """Pieces as JSON, their Markdown as text, and the scores they were read from (path, content) as a table."""
    write_json(pieces, f"{path}/pieces")
    markdown.select("markdown").write.mode("overwrite").option("lineSep", "\n\f\n").text(f"{path}/markdown")
    scores.write.mode("overwrite").parquet(f"{path}/scores")


def loc_report(files: DataFrame, k: int = 20, ignored: bool = False) -> DataFrame:
    """The line-count report as one Markdown text. files: path, language, category, code, comments, blanks.

    Summary, languages by code and by filled lines (code and comments; those without code are left out), what is excluded, and the k
    largest files by either. Each part is aggregated or cut to k rows before it becomes text.
    """
    x = files.withColumn("filled", F.col("code") + F.col("comments"))
    number = lambda c: F.format_number(c, 0)

    def rows(df: DataFrame, order: str, tie: str, cells: list, name: str) -> DataFrame:
        line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
        r = F.array_sort(F.collect_list(F.struct((-F.col(order)).alias("o"), F.col(tie).alias("t"), line.alias("line"))))
        return df.agg(F.transform(r, lambda v: v["line"]).alias(name))

    lang = x.groupBy("language", "category").agg(F.count("*").alias("files"), *[F.sum(c).alias(c) for c in ("code", "comments", "blanks", "filled")])
    cells = ["language", "category", *[number(c) for c in ("files", "code", "comments", "blanks", "filled")]]
    total = x.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("code", "comments", "blanks", "filled")])
    summary = [("Total Files", number("n")), ("Total Code LOC", number("code")), ("Total Non-empty LOC", number("filled")), ("Total Comments", number("comments")), ("Total Blanks", number("blanks")), ("Total Lines", number(F.col("filled") + F.col("blanks")))]
    total = total.select(F.array(*[F.concat(F.lit(f"| {n} | "), v, F.lit(" |")) for n, v in summary]).alias("summary"))
    by_code, by_filled = (rows(lang.where("code > 0"), o, "language", cells, n) for o, n in (("code", "by_code"), ("filled", "by_filled")))
    top = lambda by, other, name: rows(x.orderBy(F.desc(by), "path").limit(k), by, "path", [number(by), number(other), F.concat(F.lit("`"), "path", F.lit("`"))], name)
    head = "| Language | Category | Files | Code LOC | Comment LOC | Blank LOC | Non-empty LOC |\n| --- | --- | --- | --- | --- | --- | --- |"
    left_out = [f"- `{d}/`" for d in sorted(EXCLUDED_DIRS)] + [f"- `{p}`" for p in EXCLUDED_PATTERNS] + [f"- `{b}`" for b in sorted(BINARY)] + (["- patterns of .gitignore"] if ignored else [])
    one = total.crossJoin(by_code).crossJoin(by_filled).crossJoin(top("code", "filled", "top_code")).crossJoin(top("filled", "code", "top_filled"))  # a row each
    parts = [F.lit("# Lines of code\n\n## Summary\n\n| Metric | Count |\n| --- | --- |"), F.col("summary"), F.lit(f"\n## By Language (Code LOC)\n\n{head}"), F.col("by_code"), F.lit(f"\n## By Language (Non-empty LOC)\n\n{head}"), F.col("by_filled"), F.lit("\n## Exclusions\n\n" + "\n".join(left_out)), F.lit(f"\n## TOP-{k} Files by Code LOC\n\n| Code LOC | Non-empty LOC | Path |\n| --- | --- | --- |"), F.col("top_code"), F.lit(f"\n## TOP-{k} Files by Non-empty LOC\n\n| Non-empty LOC | Code LOC | Path |\n| --- | --- | --- |"), F.col("top_filled")]
    return one.select(F.concat_ws("\n", *parts).alias("report"))
