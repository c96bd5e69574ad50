"""Notes and measures: positions, rhythm and keys. notes: piece_id, measure_seq, note_seq, duration, time_signature, key_signature."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.music import beats_per_measure, duration_beats, key_name, nearest_duration, pitch, text_class

TOLERANCE = 0.1


def positions(notes: DataFrame, duration: str = "duration") -> DataFrame:
    """notes with `beat`, where each begins in its measure."""
    w = Window.partitionBy("piece_id", "measure_seq").orderBy("note_seq").rowsBetween(Window.unboundedPreceding, -1)
    return notes.withColumn("beat", F.coalesce(F.sum(duration_beats(F.col(duration))).over(w), F.lit(0.0)))


def measures(notes: DataFrame) -> DataFrame:
    """Per measure the beats it has, those it should have, and whether that is valid, an excess or short."""
    m = notes.groupBy("piece_id", "measure_seq").agg(F.sum(duration_beats(F.col("duration"))).alias("actual"), F.max(beats_per_measure(F.col("time_signature"))).alias("expected"))
    diff = F.abs(F.col("expected") - F.col("actual"))
    return m.withColumn("state", F.when(diff < TOLERANCE, "valid").when(F.col("actual") > F.col("expected") + TOLERANCE, "excess").otherwise("short"))


def corrected(notes: DataFrame) -> DataFrame:
    """notes with `fixed`: in measures with an excess every duration is scaled to fit and snapped to a standard one."""
    x = notes.join(measures(notes), ["piece_id", "measure_seq"])
    scaled = nearest_duration(duration_beats(F.col("duration")) * (F.col("expected") / F.col("actual")))
    return x.withColumn("fixed", F.when(F.col("state") == "excess", scaled).otherwise(F.col("duration"))).drop("actual", "expected", "state")


def rhythm_summary(notes: DataFrame) -> DataFrame:
    """Per piece: measures, how many were wrong, and how many still are after correction."""
    before = measures(notes).groupBy("piece_id").agg(F.count("*").alias("measures"), F.count_if(F.col("state") != "valid").alias("wrong"))
    fixed = corrected(notes).drop("duration").withColumnRenamed("fixed", "duration")
    after = measures(fixed).groupBy("piece_id").agg(F.count_if(F.col("state") != "valid").alias("still_wrong"))
    return before.join(after, "piece_id").withColumn("all_valid", F.col("still_wrong") == 0)


def filled_keys(notes: DataFrame) -> DataFrame:
    """Per measure its key; measures without one take the piece's first key other than C, else its first."""
    m = notes.groupBy("piece_id", "measure_seq").agg(F.max("key_signature").alias("key"))
    k = m.where("key is not null").groupBy("piece_id").agg(F.min_by("key", F.when(F.col("key") != "C", F.col("measure_seq"))).alias("first_other"), F.min_by("key", "measure_seq").alias("first_any"))
    x = m.join(k, "piece_id", "left")
    return x.select("piece_id", "measure_seq", F.coalesce("key", "first_other", "first_any").alias("key"))


def unpacked(files: DataFrame) -> DataFrame:
    """files (path, content) with the score inside a compressed one (.mxl): its first XML file outside META-INF that is no container.

    Spark has no reader for zip archives; each is opened where it was read. An archive that cannot be read has null content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for path, content in zip(b["path"].to_pylist(), b["content"].to_pylist(), strict=True):
                if path.lower().endswith(".mxl"):
                    try:
                        with zipfile.ZipFile(io.BytesIO(content)) as z:
                            names = [n for n in z.namelist() if n.endswith(".xml") and not n.startswith("META-INF")]
                            names = [n for n in names if "container" not in n.lower()] or names
                            content = z.read(names[0]) if names else None
                    except zipfile.BadZipFile:
                        content = None
                out.append(content)
            yield pa.RecordBatch.from_arrays([b["path"], pa.array(out, pa.binary())], names=["path", "content"])

    return files.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(run, "path string, content binary")


def best_scores(files: DataFrame) -> DataFrame:
    """Of each folder's scores (path) the one to read: compressed ones first, then by name."""
    x = files.withColumns({"folder": F.regexp_extract("path", r"^(.*?)[^/]*$", 1), "name": F.regexp_extract("path", r"([^/]*)$", 1)})
    x = x.where(F.col("name").rlike(r"\.(mxl|musicxml)$"))
    order = Window.partitionBy("folder").orderBy(~F.col("name").endswith(".mxl"), "name")
    return x.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n", "folder", "name")


#: What is read of a score. Attributes have an underscore before their names.
SCORE = "struct<part:array<struct<_id:string,measure:array<struct<_number:string,attributes:array<struct<key:array<struct<fifths:string>>,time:array<struct<beats:string,`beat-type`:string>>>>,note:array<struct<pitch:struct<step:string,alter:string,octave:string>,type:string,voice:string>>>>>>,_broken:string>"


def scores(files: DataFrame) -> DataFrame:
    """files (path, content as text or bytes) of uncompressed MusicXML, a row each: path, error, time_signature, key_signature, measures.

    Namespaces, document types and attributes do not matter. Measures of all parts follow one another; those without notes,
    time and key are left out. A measure has its part, number, time and key signature (null where it states none), and notes:
    pitch, duration (a quarter where the note has no type) and voice. Rests, and notes without pitch, are left out. The
    score's own signatures are the first that a measure states. error says why a file gave no measures: it is not well-formed XML,
    or a measure's number or a key is no integer. For .mxl see `unpacked`.
    """
    xml = F.make_valid_utf8(F.col("content").cast("string")) if dict(files.dtypes)["content"] == "binary" else F.col("content")
    x = files.select("path", F.from_xml(xml, SCORE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken", "ignoreNamespace": "true"}).alias("s"))

    def note(n):
        p = n["pitch"]
        return F.struct(pitch(p["step"], p["alter"], F.coalesce(p["octave"], F.lit(""))).alias("pitch"), F.coalesce(n["type"], F.lit("quarter")).alias("duration"), F.coalesce(n["voice"].try_cast("int"), F.lit(1)).alias("voice"))

    def measure(part, m):
        stated = lambda what: F.get(F.flatten(F.transform(F.filter(m["attributes"], lambda a: a[what].isNotNull()), lambda a: a[what])), F.lit(0))
        time, key = stated("time"), stated("key")
        full = (time["beats"] != "") & (time["beat-type"] != "")
        fifths = F.coalesce(key["fifths"], F.lit("0")).try_cast("int")
        notes = F.transform(F.filter(m["note"], lambda n: n["pitch"].isNotNull()), note)
        return F.struct(
            part["_id"].alias("part"),
            F.coalesce(m["_number"], F.lit("0")).try_cast("int").alias("number"),
            F.when(full, F.concat(time["beats"], F.lit("/"), time["beat-type"])).alias("time_signature"),
            F.when(key.isNotNull(), F.coalesce(key_name(fifths), F.lit("C"))).alias("key_signature"),
            (key.isNotNull() & fifths.isNull()).alias("odd_key"),
            F.coalesce(notes, F.array().cast("array<struct<pitch:string,duration:string,voice:int>>")).alias("notes"),
        )

    each = F.flatten(F.transform("s.part", lambda part: F.transform(F.coalesce(part["measure"], F.array()), lambda m: measure(part, m))))
    x = x.select("path", F.col("s").isNull().alias("none"), F.col("s._broken").isNotNull().alias("broken"), F.inline(F.array(F.struct(F.coalesce(each, F.array()).alias("m")))))
    odd = F.exists("m", lambda m: m["number"].isNull() | m["odd_key"])
    error = F.when(F.col("none") | F.col("broken"), "not well-formed").when(odd, "a number or key is no integer")
    kept = F.filter("m", lambda m: (F.size(m["notes"]) > 0) | m["time_signature"].isNotNull() | m["key_signature"].isNotNull())
    kept = F.transform(kept, lambda m: m.dropFields("odd_key"))
    x = x.select("path", error.alias("error"), F.when(error.isNull(), kept).otherwise(F.slice(kept, 1, 0)).alias("measures"))
    first = lambda c: F.get(F.filter(F.transform("measures", lambda m: m[c]), lambda v: v.isNotNull()), F.lit(0)).alias(c)
    return x.select("path", "error", first("time_signature"), first("key_signature"), "measures")


def parse_measures(files: DataFrame) -> DataFrame:
    """The measures of `scores`, a row each: path, measure_seq from 0, part, number, time_signature, key_signature."""
    m = scores(files).select("path", F.posexplode("measures").alias("measure_seq", "m"))
    return m.select("path", "measure_seq", "m.part", "m.number", "m.time_signature", "m.key_signature")


def parse_musicxml(files: DataFrame) -> DataFrame:
    """The notes of `scores`, a row each: path, measure_seq, part, number, note_seq, pitch, duration, voice. Notes of a chord count one after another."""
    m = scores(files).select("path", F.posexplode("measures").alias("measure_seq", "m"))
    return m.select("path", "measure_seq", "m.part", "m.number", F.posexplode("m.notes").alias("note_seq", "n")).select("path", "measure_seq", "part", "number", "note_seq", "n.*")


def placed_share(notes: DataFrame) -> DataFrame:
    """Per piece its notes, and how many have a place other than the start of their measure. notes: piece_id, beat."""
    return notes.groupBy("piece_id").agg(F.count("*").alias("notes"), F.count_if(F.col("beat").isNotNull() & (F.col("beat") != 0)).alias("placed"))


def rhythm_errors(notes: DataFrame) -> DataFrame:
    """Per piece what is wrong with its measures, joined by "; " in their order."""
    m = measures(notes).where("state <> 'valid'")
    said = F.concat(F.lit("measure "), F.col("measure_seq").cast("string"), F.lit(": "), F.col("state"), F.lit(", "), F.col("actual").cast("string"), F.lit(" beats of "), F.col("expected").cast("string"))
    each = F.array_sort(F.collect_list(F.struct("measure_seq", said.alias("said"))))
    return m.groupBy("piece_id").agg(F.concat_ws("; ", F.transform(each, lambda x: x["said"])).alias("errors"))


def classified_tokens(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("class", text_class(F.col("text")))
