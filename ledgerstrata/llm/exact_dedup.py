"""Exact duplicates by distributed most-significant-digit radix partitioning.

Documents are split by successive bytes of their normalised text. The first
digit is the byte length and the first 64 bytes, later digits are wider runs of
the bytes that follow. A document that is alone with its digits is finished; a
group whose text has ended holds equal documents. Digits are compared as bytes,
so equality rests on no digest.

Per level the bytes move in one join, and a group shrinks to one row per task
before it is counted. The groups are stored before rows are joined to them, so
both sides of that join are plain scans and adaptive execution can split a digit
that a third of all rows share. The joins that move text always shuffle, whatever
the size of the other side, so the plan of a small corpus is that of a large one.

* NULL text is empty; empty texts equal each other.
* NULL ``doc_id`` ranks below every id; a group of such rows has a NULL
  ``keep_id``.
* Rows that repeat a ``doc_id`` are rows of their own and each one is returned.
  If the repeated id is the largest of its group, one of its rows stays.
* No rows give no rows. Columns besides the two named ones are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.llm.common import lower_ascii, only_rows, stored

FIRST_DIGIT = 64
WIDTHS = (4 << 10, 64 << 10, 1 << 20)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document, all text bytes only where the first digit is shared."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        lower_ascii(F.col(text_col)).cast("binary").alias("body"),
        F.xxhash64(F.col(text_col)).alias("text_key"),
    ).select(
        "doc_id",
        "text_key",
        "body",
        F.octet_length("body").alias("size"),
        F.substring("body", 1, FIRST_DIGIT).alias("digit"),
    )
    shared = stored(
        rows.groupBy("size", "digit").agg(F.count("*").alias("n")).where("n > 1"), "radix-first"
    )
    body = F.when(F.col("n").isNotNull(), F.col("body"))
    return stored(
        rows.join(shared.hint("merge"), ["size", "digit"], "left").select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "text_key",
            "size",
            F.when(F.col("n").isNotNull(), F.col("digit")).alias("digit"),
            body.alias("body"),
            F.sha2("body", 256).alias("text_sha256"),
        ),
        "radix-rows",
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    widths: tuple[int, ...] = WIDTHS,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, text_key.

    ``text_key`` hashes the text as it was given; it only names the row.
    ``widths`` are the byte counts of the digits after the first; the last one
    repeats until every text has ended.
    """
    rows = _rows(docs, id_col, text_col)
    spark = docs.sparkSession
    open_rows = rows.where("body IS NOT NULL")
    # A group is named by the keys that its members share so far.
    active = open_rows.select("row", "size", "digit", F.lit(0).cast("long").alias("name"))
    ended = spark.createDataFrame([], "row long, name long, n long")
    offset, level = FIRST_DIGIT, 0
    while True:
        width = widths[min(level, len(widths) - 1)]
        keys = ["size", "name", "digit", "next"]
        if level == 0:
            # The first digits are still part of the key; from here on the name stands for them.
            current = open_rows.select(
                "row", "size", F.lit(0).cast("long").alias("name"), "digit",
                F.substring("body", offset + 1, width).alias("next"),
            )
        else:
            current = active.hint("merge").join(open_rows.select("row", "body"), "row").select(
                "row", "size", "name", F.lit(None).cast("binary").alias("digit"),
                F.substring("body", offset + 1, width).alias("next"),
            )
        if level:
            keys.remove("digit")
        groups = stored(
            current.groupBy(*keys)
            .agg(F.max("row").alias("new_name"), F.count("*").alias("n"))
            .where("n > 1"),
            "radix-groups",
        )
        split = stored(
            current.join(groups.hint("merge"), keys).select("row", "size", F.col("new_name").alias("name"), "n"),
            "radix-level",
        )
        offset += width
        ended = ended.unionByName(split.where(F.col("size") <= offset).select("row", "name", "n"))
        active = split.where(F.col("size") > offset).select("row", "size", "name")
        level += 1
        if active.isEmpty():
            break

    # The last of equal documents stays; the struct breaks ties between repeated ids.
    winner = F.max(F.struct("doc_id", "row")).alias("best")
    members = ended.join(rows.select("row", "doc_id"), "row")
    classes = stored(members.groupBy("name", "n").agg(winner), "radix-classes")
    verdicts = ended.select("row", "name").join(classes, "name").select(
        F.col("row").alias("member"), "n", "best"
    )
    return rows.join(verdicts, F.col("row") == F.col("member"), "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("best.row") == F.col("row"))).alias("kept"),
        "text_sha256",
        "text_key",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay."""
    return only_rows(docs, exact_groups(docs, id_col, text_col).where("kept"), id_col, text_col)
