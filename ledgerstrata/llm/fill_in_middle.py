"""Fill-in-the-middle texts: two cuts per document, found in an indexable skip list.

A text is cut into units: a word with the spaces before it, or the spaces that end the
text. The units of a document that is to be rearranged are the nodes of a skip list.
Every link of every lane carries two widths, how many units and how many code points it
passes. Going down from the top lane and along each lane as far as the wanted rank
allows, the widths passed add up to exactly that rank, and the other sum is where the
text is to be cut. A node rises to the next lane with a probability of one in four,
decided by a hash of its rank, so equal texts have equal lists.

Cuts and form depend on the id alone (through SHA-256), so rows may be anywhere and a
retried task gives the same text. No row needs another: nothing is shuffled.

* NULL text is empty. An empty text, one that contains a sentinel, or one not drawn for
  rearranging stays as it is (``plain``), with no prefix and middle.
* A NULL id counts as the empty text in the hash. Repeated rows come out alike.
* Text of any length is read in blocks; a long one needs five numbers per unit.
* Columns of the input pass through; those added get longer names where they clash.
* No rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerstrata.llm.common import give_back, spare_name

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE = 50  # documents in a hundred that are rearranged
SPM = 80  # of these, those in a hundred with the suffix first
SEED = 42
BLOCK = 1 << 20
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def unit_widths(text: bytes) -> np.ndarray:
    """Code points of every unit of a text in UTF-8."""
    found, open_points, in_word = [], 0, False
    for start in range(0, len(text), BLOCK):
        data = np.frombuffer(text, np.uint8, min(BLOCK, len(text) - start), start)
        space = (data == 32) | ((data >= 9) & (data <= 13))
        # Code points up to and with each byte; continuation bytes open none.
        points = np.cumsum((data & 0xC0) != 0x80)
        # A unit ends where a space follows a byte of a word.
        before = np.r_[in_word, ~space[:-1]]
        ends = np.flatnonzero(space & before)
        passed = np.r_[0, points][ends]
        found.append(np.diff(np.r_[-open_points, passed]))
        open_points = int(points[-1] - (passed[-1] if len(passed) else -open_points))
        in_word = not space[-1]
    if open_points:
        found.append(np.array([open_points]))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _rises(ranks: np.ndarray, lane: int) -> np.ndarray:
    """Which nodes of a lane also stand in the next: one in four, by a hash of the rank."""
    mixed = ranks.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return (mixed >> np.uint64(2 * lane)) & np.uint64(3) == 0


class SkipList:
    """Units in order, with express lanes that carry unit widths and code-point widths.

    ``lanes[k]`` holds, per link, the units and code points it passes and the link of
    lane ``k - 1`` that starts at the same place. The first link of every lane starts
    at the head.
    """

    def __init__(self, widths: np.ndarray):
        units, points = np.ones(len(widths), np.int64), widths.astype(np.int64)
        ranks = np.arange(len(widths))
        self.lanes = [(units, points, ranks)]
        while len(ranks) > 1 and len(self.lanes) < 32:
            rises = _rises(ranks, len(self.lanes) - 1)
            rises[0] = True
            below = np.flatnonzero(rises)
            if len(below) == len(ranks):
                break
            units, points = np.add.reduceat(units, below), np.add.reduceat(points, below)
            ranks = ranks[below]
            self.lanes.append((units, points, below))

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        link, passed, points = 0, 0, 0
        for lane, (unit_width, point_width, below) in enumerate(reversed(self.lanes)):
            while link < len(unit_width) and passed + unit_width[link] <= rank:
                passed += int(unit_width[link])
                points += int(point_width[link])
                link += 1
            if passed == rank or link == len(unit_width):
                break
            link = int(below[link])
        return points


def draws(doc_id, seed: int = SEED) -> list[int]:
    """Four unsigned 32-bit numbers that belong to an id."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    head = hashlib.sha256(key.encode()).hexdigest()
    return [int(head[i : i + 8], 16) for i in range(0, 32, 8)]


def rearrange(doc_id, text: bytes, rate: int = RATE, spm: int = SPM, seed: int = SEED):
    """``(n, form, prefix_chars, middle_chars, output)`` of one document."""
    widths = unit_widths(text)
    n = len(widths)
    h1, h2, h3, h4 = draws(doc_id, seed)
    marked = any(mark.encode() in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or h3 % 100 >= rate:
        return n, "plain", None, None, text
    units = SkipList(widths)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = units.points_before(first), units.points_before(second)
    whole = text.decode("utf-8", "surrogateescape")
    prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
    if h4 % 100 < spm:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, a, b - a, output.encode("utf-8", "surrogateescape")


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: int = RATE,
    spm: int = SPM,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``rate`` documents in a hundred are rearranged, ``spm`` in a hundred of these with
    the suffix first.
    """

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            ids, texts = batch.column(id_at), batch.column(text_at).cast(pa.binary())
            first, rows, size = 0, [], 0
            for row in range(batch.num_rows):
                rows.append(rearrange(ids[row].as_py(), texts[row].as_py() or b"", rate, spm, seed))
                size += len(rows[-1][4])
                if size >= 4 << 20 or row + 1 == batch.num_rows:
                    part = batch.slice(first, len(rows))
                    added = [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)]
                    added[4] = added[4].cast(pa.string())
                    yield pa.RecordBatch.from_arrays([*part.columns, *added], names=names)
                    first, rows, size = row + 1, [], 0
        give_back()

    if docs.schema[text_col].dataType != StringType():
        docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)
    types = (LongType(), StringType(), LongType(), LongType(), StringType())
    fields = [StructField(spare_name(docs, name), kind) for name, kind in zip(ADDED, types)]
    schema = StructType([*docs.schema.fields, *fields])
    names = schema.names
    return docs.mapInArrow(run, schema)


def restored_text(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that an output of some form was made from."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    middle = F.substring_index(output, MIDDLE, -1)
    head = F.substring_index(F.substr(output, F.lit(4)), MIDDLE, 1)

    def between(mark: str) -> list[Column]:
        return [F.substring_index(head, mark, 1), F.substring_index(head, mark, -1)]

    (psm_prefix, psm_suffix), (spm_suffix, spm_prefix) = between(SUFFIX), between(PREFIX)
    return (
        F.when(form == "psm", F.concat(psm_prefix, middle, psm_suffix))
        .when(form == "spm", F.concat(spm_prefix, middle, spm_suffix))
        .otherwise(output)
    )


def middle_digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n, form, widths, and digests of the output and the restored text."""
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    made = fill_in_middle(named).drop("text")
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored_text().cast("binary"), 256).alias("restored_sha256"),
    )


def middle_sql() -> str:
    """The digests as SQL over ``documents``."""
    unit = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

    def draw(i: int) -> str:
        return f"('0x' || substr(hex, {8 * i + 1}, 8))::BIGINT"

    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
        u AS (SELECT *, regexp_extract_all(t, '{unit}') AS units FROM d),
        c AS (SELECT *, len(units) AS n,
                least({draw(0)} % (len(units) + 1), {draw(1)} % (len(units) + 1)) AS a,
                greatest({draw(0)} % (len(units) + 1), {draw(1)} % (len(units) + 1)) AS b FROM u),
        p AS (SELECT *, array_to_string(units[1:a], '') AS prefix,
                array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                     OR {draw(2)} % 100 >= {RATE} THEN 'plain'
                     WHEN {draw(3)} % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM c)
        SELECT doc_id, n, form,
            CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t
                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
            sha256(t) AS restored_sha256
        FROM p"""
