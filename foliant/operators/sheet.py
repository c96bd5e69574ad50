"""Text on music sheets: which tokens to keep, what they say about the piece, and its checks.

tokens: piece_id, seq, region (header, footer, between_staff...), text, confidence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.music import DYNAMICS, EXPRESSIONS, LEAST_CONFIDENCE, NOISE, SHEET_WORDS, text_class
from foliant.operators.music import filled_keys


def valid_tokens(tokens: DataFrame) -> DataFrame:
    """tokens with `valid`. The order of the rules counts: noise goes first, so the dynamic that is also noise is lost."""
    t, low, sure = F.col("text"), F.lower(F.trim("text")), F.col("confidence")
    digits, short = t.rlike(r"^\p{Nd}+$"), F.length(low) <= 2
    number = digits & (t.try_cast("int") < 500)
    between = F.col("region").startswith("between_staff")
    header = F.col("region") == "header"
    keep = (
        F.when(sure < LEAST_CONFIDENCE, False)
        .when(low.isin(*NOISE), False)
        .when(short & ~low.isin(*DYNAMICS) & ~digits, False)
        .when(header & (F.length(t) >= 3) & (sure >= 0.7), True)
        .when(between, low.isin(*DYNAMICS, *EXPRESSIONS, *SHEET_WORDS) | F.coalesce(number, F.lit(False)) | ((sure >= 0.8) & (F.length(t) >= 4)))
        .when(F.col("region") == "footer", t.contains("©") | digits | (sure >= 0.7))
        .otherwise(True)
    )
    return tokens.withColumn("valid", keep)


def in_staves(tokens: DataFrame, margin: float = 30.0) -> DataFrame:
    """tokens (y, staves: array of top_y and bottom_y) with whether they lie in a staff, give or take a margin."""
    return tokens.withColumn("in_staff", F.exists("staves", lambda s: F.col("y").between(s["top_y"] - margin, s["bottom_y"] + margin)))


def metadata(tokens: DataFrame) -> DataFrame:
    """Per piece its dynamics and expressions (sorted, joined by commas), first tempo, largest measure number and last copyright line."""
    x = tokens.withColumns({"class": text_class(F.col("text")), "low": F.lower(F.trim("text"))})
    is_ = lambda c: F.col("class") == c
    listed = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(F.when(is_(c), F.col("low")))))
    copyright_ = (F.col("region") == "footer") & (F.col("text").contains("©") | F.col("low").contains("copyright"))
    return x.groupBy("piece_id").agg(
        listed("dynamic").alias("dynamics"),
        listed("expression").alias("expressions"),
        F.min_by("text", F.when(is_("tempo"), F.col("seq"))).alias("tempo"),
        F.max(F.when(is_("measure_number"), F.col("low").try_cast("int"))).alias("measure_count"),
        F.max_by("text", F.when(copyright_, F.col("seq"))).alias("copyright"),
    )


def header_fields(lines: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """Per piece dedication, composer and title from header lines (piece_id, line_no, line), and the header's tokens (piece_id, seq, text).

    A line is a dedication (it says so, or is the first and names a person) while there is none, else a composer (it
    has a year; the last counts), else a title (under 30 characters, while there is none). Without a title it is the first
    token, in order from the top, under 15 characters that the dedication does not hold and that is not the composer.
    """
    low = F.lower("line")
    says = low.contains("omistettu") | low.contains("dedicated") | low.contains("für") | low.contains("for")
    named = (F.col("line_no") == 0) & F.regexp_replace("line", r"[^a-zA-ZäöåÄÖÅ\s\-]", "").rlike(r"[A-ZÄÖÅ][a-zäöå]+\s+[A-ZÄÖÅ][a-zäöå]+")
    x = lines.withColumns({"dedicates": says | named, "year": F.col("line").rlike(r"\d{4}")})
    first = x.groupBy("piece_id").agg(F.min(F.when(F.col("dedicates"), F.col("line_no"))).alias("d"), F.min_by("line", F.when(F.col("dedicates"), F.col("line_no"))).alias("dedication"))
    x = x.join(first, "piece_id").where("d is null or line_no <> d")
    clean = F.trim(F.regexp_replace(F.regexp_replace("line", r"^[a-z]\s+", ""), r"\s+\d$", ""))
    rest = x.groupBy("piece_id").agg(F.max_by(clean, F.when(F.col("year"), F.col("line_no"))).alias("composer"), F.min_by("line", F.when(~F.col("year") & (F.length("line") < 30) & ~F.col("line").eqNullSafe(F.col("dedication")), F.col("line_no"))).alias("title"))
    found = first.drop("d").join(rest, "piece_id", "left")
    if tokens is None:
        return found
    t = tokens.select("piece_id", "seq", F.trim("text").alias("text")).join(found.where("title is null"), "piece_id")
    t = t.where((F.length("text") < 15) & ~F.coalesce("dedication", F.lit("")).contains(F.col("text")) & ~F.col("text").eqNullSafe(F.col("composer")))
    last = t.groupBy("piece_id").agg(F.min_by("text", "seq").alias("short"))
    return found.join(last, "piece_id", "left").withColumn("title", F.coalesce("title", "short")).drop("short")


def time_hint(tokens: DataFrame) -> DataFrame:
    """Per piece the first time signature in its header: digits over 2, 4, 8 or 16, or a common-time sign."""
    t = F.trim("text")
    sig = F.regexp_extract(t, r"(\d+)/(\d+)", 0)
    ok = F.regexp_extract(t, r"(\d+)/(\d+)", 2).isin("2", "4", "8", "16")
    hint = F.when(ok, sig).when(F.upper(t).isin("C", "COMMON TIME"), "4/4")
    x = tokens.where("region = 'header'").withColumn("hint", hint).where("hint is not null")
    return x.groupBy("piece_id").agg(F.min_by("hint", "seq").alias("time_signature"))


def clef_hint(images: DataFrame) -> DataFrame:
    """images (staves, width, height) with clef: G wherever there is a staff and a strip of the image to look at, else null."""
    first = F.get("staves", F.lit(0))
    tall = first["bottom_y"] - first["top_y"]
    left = (F.col("width") * 0.05).cast("int")
    wide = F.least(F.col("width"), left + (F.col("width") * 0.15).cast("int")) - left
    high = F.least(F.col("height"), first["bottom_y"] + tall) - F.greatest(F.lit(0), first["top_y"] - tall)
    return images.withColumn("clef", F.when((F.size("staves") > 0) & (wide > 0) & (high > 0), "G"))


def interline(images: DataFrame, distance: str = "interline") -> DataFrame:
    """Per image the median distance of staff lines, zeros and nulls left out. images: img_id, interline, a row per staff."""
    return images.where(F.col(distance) != 0).groupBy("img_id").agg(F.percentile(distance, F.lit(0.5)).alias(distance))


def structure_hints(images: DataFrame, tokens: DataFrame) -> DataFrame:
    """Per piece the clef and the time signature that its image and header suggest. images: piece_id, staves, width, height."""
    clef = clef_hint(images).select("piece_id", "clef")
    return clef.join(time_hint(tokens), "piece_id", "left")


def settled_measures(measures: DataFrame, hints: DataFrame) -> DataFrame:
    """measures (piece_id, measure_seq, time_signature, key_signature) with one time signature per piece and keys filled in."""
    m = unified_time(measures, hints.select("piece_id", "time_signature"))
    keys = filled_keys(m).withColumnRenamed("key", "key_signature")
    return m.drop("key_signature").join(keys, ["piece_id", "measure_seq"])


def settled_metadata(found: DataFrame, score: DataFrame) -> DataFrame:
    """found (piece_id, ...) with what the score states in its place: score has piece_id and some of found's columns."""
    names = [c for c in score.columns if c != "piece_id"]
    x = found.join(score.withColumnsRenamed({c: f"score_{c}" for c in names}), "piece_id", "left")
    return x.select(*[F.coalesce(f"score_{c}", c).alias(c) if c in names else F.col(c) for c in found.columns])


def unified_time(measures: DataFrame, hints: DataFrame) -> DataFrame:
    """measures (piece_id, measure_seq, time_signature) all with one signature: the score's first, the header's, or 4/4."""
    own = measures.where("time_signature is not null").groupBy("piece_id").agg(F.min_by("time_signature", "measure_seq").alias("own"))
    x = measures.drop("time_signature").join(own, "piece_id", "left").join(hints.withColumnRenamed("time_signature", "hint"), "piece_id", "left")
    return x.withColumn("time_signature", F.coalesce("own", "hint", F.lit("4/4"))).drop("own", "hint")


def checks(pieces: DataFrame) -> DataFrame:
    """Findings per piece, from one row each: title, composer, omr_success, omr_engine, staff_count, measure_count, still_wrong, without_time, without_beat."""
    ok = F.coalesce("omr_success", F.lit(False))
    has = ok & (F.col("measure_count") > 0)
    rules = [
        (F.coalesce("title", F.lit("")) == "", "metadata_title", "warning"),
        (F.coalesce("composer", F.lit("")) == "", "metadata_composer", "warning"),
        (ok & (F.col("measure_count") == 0), "omr_measures", "warning"),
        (~ok & (F.col("omr_engine") == "none"), "omr_available", "info"),
        (F.col("staff_count") == 0, "staff_detection", "fail"),
        (has & (F.col("still_wrong") > 0), "rhythm_validation", "warning"),
        (has & (F.col("without_time") > 0), "time_signature_coverage", "warning"),
        (has & (F.col("without_beat") > F.col("measure_count")), "beat_positions", "warning"),
    ]
    found = F.array_compact(F.array(*[F.when(F.coalesce(holds, F.lit(False)), F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"))) for holds, name, severity in rules]))
    return pieces.select("piece_id", F.explode(found).alias("f")).select("piece_id", "f.check", "f.severity")


def status(pieces: DataFrame) -> DataFrame:
    """Per piece pass, warning or fail."""
    s = checks(pieces).groupBy("piece_id").agg(F.when(F.bool_or(F.col("severity") == "fail"), "fail").when(F.bool_or(F.col("severity") == "warning"), "warning").otherwise("pass").alias("status"))
    return pieces.select("piece_id").join(s, "piece_id", "left").select("piece_id", F.coalesce("status", F.lit("pass")).alias("status"))
