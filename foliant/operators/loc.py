"""Lines of code by language. lines: path, line_no, text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.sources.folders import list_files, read_contents

# Languages by extension (of two claims the later counts), comment styles and categories.
EXTENSIONS = {".py": "Python", ".js": "JavaScript", ".ts": "TypeScript", ".tsx": "TypeScript", ".go": "Go", ".java": "Java", ".cs": "C#", ".cpp": "C++", ".cc": "C++", ".cxx": "C++", ".hpp": "C++", ".c": "C", ".h": "C", ".rs": "Rust", ".rb": "Ruby", ".php": "PHP", ".kt": "Kotlin", ".swift": "Swift", ".sql": "SQL", ".sh": "Shell", ".bash": "Shell", ".ps1": "PowerShell", ".yaml": "YAML", ".yml": "YAML", ".toml": "TOML", ".json": "JSON", ".md": "Markdown", ".xml": "XML", ".html": "HTML", ".htm": "HTML", ".css": "CSS"}
HASH = ("Python", "Shell", "PowerShell", "YAML")
SLASH = ("JavaScript", "TypeScript", "Java", "C++", "C", "C#", "Go", "Rust", "PHP")
MARKUP = ("HTML", "XML")
DATA, DOCS = ("JSON", "XML"), ("Markdown",)
# Folders, suffixes and patterns of files that are not counted.
EXCLUDED_DIRS = ("node_modules", "dist", "build", ".next", ".nuxt", ".cache", ".venv", "venv", "__pycache__", ".git", "coverage", "target", "out", ".turbo", ".idea", ".vscode", ".pytest_cache")
BINARY = (".pdf", ".png", ".jpg", ".jpeg", ".gif", ".bmp", ".ico", ".svg", ".zip", ".tar", ".gz", ".7z", ".rar", ".exe", ".dll", ".so", ".dylib", ".pyc", ".pyo", ".pyd", ".db", ".sqlite", ".sqlite3", ".xlsx", ".xls", ".doc", ".docx", ".mxl", ".omr")
EXCLUDED_PATTERNS = (r"\.min\.", r"\.map$", r"package-lock\.json$", r"yarn\.lock$", r"pnpm-lock\.yaml$", r"poetry\.lock$", r"Pipfile\.lock$")


def suffix(path):
    """The last dot of a file's name and what follows; none for a name that only starts with a dot, or ends with one."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def language(path):
    pairs = [F.lit(x) for kv in EXTENSIONS.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), suffix(path)), F.lit("Other"))


def category(lang):
    return F.when(lang.isin(*DATA), "data").when(lang.isin(*DOCS), "docs").otherwise("code")


def excluded(path):
    """Whether a path lies in an excluded folder, is binary by its suffix, or matches a pattern (in any case)."""
    folder = F.arrays_overlap(F.split(path, "/"), F.array(*[F.lit(d) for d in EXCLUDED_DIRS]))
    return folder | suffix(path).isin(*BINARY) | path.rlike("(?i)" + "|".join(EXCLUDED_PATTERNS))


def read_ignored(spark: SparkSession, root: str) -> DataFrame:
    """pattern: the lines of root's .gitignore, without blank lines and comments; none where there is no such file.

    It is one small file, so the driver opens it.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root, ".gitignore")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    lines = []
    if fs.exists(path):
        stream = fs.open(path)
        lines = [x.strip() for x in spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()]
        stream.close()
    found = {x.rstrip("/") for x in lines if x and not x.startswith("#")}
    return spark.createDataFrame([(x,) for x in sorted(found)], "pattern string")


def ignored_by(path, pattern):
    """Whether a path holds a pattern's text, or matches it with * for anything, wherever: no other wildcard counts."""
    return path.contains(pattern) | (pattern.contains("*") & F.rlike(path, F.regexp_replace(pattern, r"\*", ".*")))


#: Patterns that are tried in one pass over the paths.
PATTERNS = 1_000


def without_excluded(files: DataFrame, ignored: DataFrame | None = None, path: str = "path") -> DataFrame:
    """files (path) that are not `excluded`, nor `ignored_by` a pattern: a filter for each block of PATTERNS patterns, no join."""
    kept = files.where(~excluded(F.col(path)))
    if ignored is None:
        return kept
    patterns = [r["pattern"] for r in ignored.collect()]  # the lines of one file that the driver has read
    for i in range(0, len(patterns), PATTERNS):
        block = F.array(*[F.lit(p) for p in patterns[i : i + PATTERNS]])
        kept = kept.where(~F.exists(block, lambda p: ignored_by(F.col(path), p)))
    return kept


def list_sources(spark: SparkSession, root: str, use_ignored: bool = False) -> DataFrame:
    """path (below root), size and modified of the files that count; hidden names are names like others, excluded folders are not opened."""
    files = list_files(spark, root, EXCLUDED_DIRS).withColumn("_full", F.concat(F.lit(root.rstrip("/") + "/"), "path"))
    kept = without_excluded(files, path="_full").drop("_full")
    return without_excluded(kept, read_ignored(spark, root)) if use_ignored else kept


def read_lines(spark: SparkSession, root: str, use_ignored: bool = False) -> DataFrame:
    """path (below root), line_no and text of the files that count, with those whose names begin with a dot or an underscore.

    What is excluded is never opened, and links to folders are not followed. Bytes that are no UTF-8 are left out. Lines end with a
    line feed, a carriage return or both; a last line without text is none. Empty files, and files that may not be read, give nothing.
    """
    x = read_contents(list_sources(spark, root, use_ignored), root)
    text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\ufffd", "")
    lines = F.split(F.regexp_replace(text, r"(\r\n|\r|\n)\z", ""), r"\r\n|\r|\n", -1)
    return x.where(F.length("content") > 0).select("path", F.posexplode(lines).alias("line_no", "text"))


def classified(lines: DataFrame) -> DataFrame:
    """lines with language, code, comment and blank (0 or 1); a line with code and a comment behind it counts as both.

    Inside block comments the state after a line is that of the last line so far that opens or closes one. A line that
    opens one and does not close it is all comment; a line that closes one opened before counts as code.
    """
    t = F.regexp_replace("text", r"^\s+|\s+$", "")
    x = lines.select("path", "line_no", t.alias("t"), language(F.col("path")).alias("language"))
    lang = F.col("language")
    slash, markup = lang.isin(*SLASH), lang.isin(*MARKUP)
    has = lambda s: F.col("t").contains(s)
    closes = (slash & has("*/")) | (markup & has("-->"))
    opens = (slash & has("/*")) | (markup & has("<!--"))
    mark = F.when(closes, 0).when(opens, 1)
    w = Window.partitionBy("path").orderBy("line_no")
    x = x.withColumn("_mark", mark).withColumn("_in", F.coalesce(F.last("_mark", ignorenulls=True).over(w), F.lit(0)))
    blank = F.col("t") == ""
    before = lambda sep: F.trim(F.substring_index("t", sep, 1))
    inside = (slash | markup) & (F.col("_in") == 1)
    hash_comment = lang.isin(*HASH) & F.col("t").startswith("#")
    # a comment that follows code on its line: the marker before which the code stands
    tail = F.when(slash & has("//"), before("//")).when((lang == "SQL") & has("--"), before("--")).when(slash & has("/*") & has("*/"), before("/*")).when(markup & has("<!--") & has("-->"), before("<!--"))
    comment = ~blank & (inside | hash_comment | tail.isNotNull())
    code = ~blank & ~inside & ~hash_comment & F.coalesce(tail != "", F.lit(True))
    return x.select("path", "line_no", "language", code.cast("int").alias("code"), comment.cast("int").alias("comment"), blank.cast("int").alias("blank"))


def files(lines: DataFrame) -> DataFrame:
    """Per file its language, category and counts; empty files are left out."""
    g = classified(lines).groupBy("path", "language").agg(F.sum("code").alias("code"), F.sum("comment").alias("comments"), F.sum("blank").alias("blanks"), F.count_if(F.col("blank") == 0).alias("non_empty"))
    return g.withColumn("category", category(F.col("language"))).where("non_empty > 0")


def by_language(lines: DataFrame) -> DataFrame:
    g = files(lines).groupBy("language", "category").agg(F.count("*").alias("files"), F.sum("code").alias("code"), F.sum("comments").alias("comments"), F.sum("blanks").alias("blanks"), F.sum("non_empty").alias("non_empty"))
    return g.where("code > 0")


def top_files(lines: DataFrame, k: int = 20, by: str = "code") -> DataFrame:
    """The k files with most lines of code, or most lines that are not blank (by="filled": code and comments)."""
    return files(lines).withColumn("filled", F.col("code") + F.col("comments")).orderBy(F.desc(by), "path").limit(k).drop("filled")
