"""Small tables that hold the awkward cases every corpus operator must stand."""

from __future__ import annotations

# Names that operators use for columns of their own.
CLASHING = (
    "kept keep_id digit size row body n text_key fp fingerprint component_id score predicted "
    "held_out features label unit start d2 piece length part place sequence_id offset tokens "
    "topic weight probability sampled mix_topic mix_tokens quality_score block role key path form "
    "prefix_chars middle_chars output toxicity passages vector code error"
).split()

LONG = " ".join(f"word{i % 977} and more of it," for i in range(40_000))
PROSE = (
    "The river ran past the old mill and the children followed it down to the harbour where "
    "boats waited for the evening tide while gulls circled above the wet stones of the quay "
    "and an old man mended nets with patient hands telling stories to nobody in particular "
    "about storms he had met and islands he had lost and found again over many slow years."
)

ROWS = [
    (1, PROSE, "en", "a"),
    (2, PROSE.upper(), "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (5, " \t\n ", "de", None),
    (6, LONG, "en", "b"),
    (7, "Ünïcode WÖRDS ünd mehr\nÜnïcode WÖRDS ünd mehr\n", "de", "b"),
    (7, "Ünïcode WÖRDS ünd mehr\nÜnïcode WÖRDS ünd mehr\n", "de", "b"),
    (8, "one", "en", "c"),
    (8, "another text with the same id", "en", "c"),
    (None, PROSE, "en", "a"),
    (None, "no id at all", None, None),
    (9, PROSE + " Indeed.", "en", "a"),
    (10, "!!! ### $$$ %%% |||", "en", "a"),
    (11, "one", "fr", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def documents(spark, rows=ROWS, clash: bool = True):
    """The rows as a table, with columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({name: F.lit(f"given {name}") for name in CLASHING}) if clash else df


def empty(spark):
    return documents(spark, [])


def key(row):
    return tuple((value is None, str(value)) for value in row)


def words(text):
    import re

    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def lower(text):
    return (text or "").encode().lower()
