"""Scalar functions for notes and measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Beats of each duration, in the order in which ties are resolved.
DURATIONS = {"whole": 4.0, "half": 2.0, "quarter": 1.0, "eighth": 0.5, "16th": 0.25, "32nd": 0.125, "64th": 0.0625, "breve": 8.0, "long": 16.0}
DYNAMICS = ("ppp", "pp", "p", "mp", "mf", "f", "ff", "fff", "sfz", "sfp", "fp", "rf", "rfz", "fz")
EXPRESSIONS = (
    "cresc", "decresc", "dim", "crescendo", "diminuendo",
    "rit", "ritard", "ritardando", "rall", "rallentando",
    "accel", "accelerando", "a tempo", "tempo primo",
    "poco a poco", "subito", "molto", "sempre",
    "dolce", "espressivo", "cantabile", "legato", "staccato",
    "marcato", "tenuto", "pizz", "arco",
    "tasto", "ponticello", "normale", "metallico",
    "tambora", "rasgueado", "rasg", "golpe",
    "lontano", "misterioso", "con fuoco", "con brio",
    "l.v.", "let vibrate", "in tempo",
)
# Tokens that are noise of recognition (one dynamic among them), and other words of sheets.
NOISE = ("fer", "ep", "ef", "eff", "wth", "leap", "ty", "ocr", "or", "op", "of", "oe", "oer", "rer", "ee", "ff", "rr", "tt", "hh")
SHEET_WORDS = ("andante", "allegro", "adagio", "presto", "moderato", "largo", "lento", "vivace", "grave", "maestoso", "cvii", "cvi", "cv", "civ", "ciii", "cii", "ci", "harm", "harmonics", "nat", "natural")
LEAST_CONFIDENCE = 0.55
KEYS = {-7: "Cb", -6: "Gb", -5: "Db", -4: "Ab", -3: "Eb", -2: "Bb", -1: "F", 0: "C", 1: "G", 2: "D", 3: "A", 4: "E", 5: "B", 6: "F#", 7: "C#"}


def beats_per_measure(signature: Column) -> Column:
    """Quarter-like beats of a time signature; compound eighths count in threes; anything unreadable is 4."""
    n, d = F.regexp_extract(signature, r"^(\d+)/(\d+)$", 1).try_cast("int"), F.regexp_extract(signature, r"^(\d+)/(\d+)$", 2).try_cast("int")
    return F.when(signature == "C", 4.0).when(signature == "C|", 2.0).when((d == 8) & (n % 3 == 0), n / F.lit(3.0)).when(n.isNotNull() & d.isNotNull(), n.cast("double")).otherwise(4.0)


def duration_beats(duration: Column) -> Column:
    pairs = [x for k, v in DURATIONS.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(duration)), F.lit(1.0))


def nearest_duration(beats: Column) -> Column:
    """Name of the standard duration closest to so many beats; of equals the first listed."""
    return F.array_min(F.array(*[F.struct(F.abs(F.lit(v) - beats).alias("off"), F.lit(i).alias("at"), F.lit(k).alias("name")) for i, (k, v) in enumerate(DURATIONS.items())]))["name"]


def text_class(text: Column) -> Column:
    """dynamic, expression, tempo, measure_number or text, tried in this order."""
    low = F.lower(F.trim(text))
    expression = F.lit(False)
    for e in EXPRESSIONS:
        expression = expression | low.contains(e)
    return F.when(low.isin(*DYNAMICS), "dynamic").when(expression, "expression").when(low.contains("=") & low.rlike(r"\d"), "tempo").when(low.rlike(r"^\d{1,9}$") & (low.try_cast("int") < 500), "measure_number").otherwise("text")


def pitch(step: Column, alter: Column, octave: Column) -> Column:
    """Step, sharp or flat, octave; other alterations are not written; null without a step (a rest)."""
    return F.concat(step, F.when(alter == "1", "#").when(alter == "-1", "b").otherwise(""), octave.cast("string"))


def key_name(fifths: Column) -> Column:
    pairs = [x for k, v in KEYS.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), fifths.cast("int")), F.lit("C"))


def scale_factor(interline: Column) -> Column:
    """How much to enlarge an image so that staff lines lie 20 pixels apart, if they lie under 12."""
    return F.when((interline <= 0) | (interline >= 12), 1.0).otherwise(20.0 / interline)
