"""Best-fit packing by patterns fitted with non-negative least squares.

Only the histogram of piece lengths decides the plan: at most ``size`` numbers,
whatever the corpus. Patterns of a few lengths that together fill a sequence are
enumerated, their repeat counts are fitted to the histogram by non-negative
least squares, rounded, and taken as far as the histogram can pay for them; those
that round to nothing are not used. So round after round on what is left. The residual is packed best-fit decreasing, by lengths
and not by pieces. The plan is a list of runs: "pieces a..b of length n go to
sequences s.., at offset o", whose number is bounded by the lengths and
patterns, so it may travel to every task. Pieces are numbered inside their
length from per-task counts, so a length that a third of all pieces share is
never gathered or sorted.

* Every document gets the end id, so NULL and empty texts are one id long.
* Only documents longer than ``size`` are cut, into pieces of ``size``.
* Rows that repeat an id are packed as often as they come; NULL ids are kept.
* No rows give no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerstrata.llm.common import stored
from ledgerstrata.llm.encoding import WordEncoder, encode_batches

PIECES = (
    "doc_id long, piece int, start long, length int, ids_crc32 long, part int, place long"
)
PATTERNS_PER_ROUND = 600
ROUNDS = 40
MOST_PIECES = 4


# --- the plan: numbers of sequences by pattern, from the histogram alone --------------


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, steps: int = 300) -> np.ndarray:
    """``x >= 0`` that nearly minimises ``|a x - b|``, by accelerated projected gradients."""
    gram, target = a.T @ a, a.T @ b
    # The largest row sum bounds the largest eigenvalue.
    rate = 1.0 / max(float(np.abs(gram).sum(1).max()), 1e-12)
    x = y = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(steps):
        new = np.maximum(y - rate * (gram @ y - target), 0)
        faster = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / faster * (new - x)
        x, t = new, faster
    return x


def candidate_patterns(counts: np.ndarray, size: int, most: int, rng) -> list[tuple[int, ...]]:
    """Patterns of up to ``most`` present lengths that fill a sequence exactly.

    A pattern starts with a present length; further lengths are drawn in
    proportion to the counts, and the last is the one that closes the gap.
    """
    present = np.flatnonzero(counts)
    if not len(present):
        return []
    weights = counts[present] / counts[present].sum()
    out = {}
    # Long lengths are the hard ones, so each one that is left starts some patterns.
    starts = present[::-1]
    tries = max(1, 4 * PATTERNS_PER_ROUND // len(starts))
    for first in starts.tolist():
        for _ in range(tries):
            lengths, gap = [first], size - first
            while gap and len(lengths) < most:
                if gap < len(counts) and counts[gap]:
                    lengths.append(gap)
                    gap = 0
                    break
                fitting = np.searchsorted(present, gap, "right")
                if not fitting:
                    break
                share = weights[:fitting]
                pick = int(present[rng.choice(fitting, p=share / share.sum())])
                lengths.append(pick)
                gap -= pick
            if gap == 0:
                key = tuple(sorted(lengths, reverse=True))
                need = Counter(key)
                if all(counts[n] >= k for n, k in need.items()):
                    out[key] = None
            if len(out) >= PATTERNS_PER_ROUND:
                return list(out)
    return list(out)


def fit_patterns(counts: np.ndarray, size: int, most: int = MOST_PIECES) -> list[tuple[tuple[int, ...], int]]:
    """``(pattern, repeats)`` taken from ``counts``, which is reduced in place."""
    rng = np.random.default_rng(7)
    taken = []
    if counts[size]:
        taken.append(((size,), int(counts[size])))
        counts[size] = 0
    for _ in range(ROUNDS):
        patterns = candidate_patterns(counts, size, most, rng)
        if not patterns:
            break
        matrix = np.zeros((size + 1, len(patterns)))
        for j, pattern in enumerate(patterns):
            np.add.at(matrix[:, j], list(pattern), 1.0)
        used = matrix.any(1)
        scale = max(float(counts.max()), 1.0)
        repeats = nonnegative_least_squares(matrix[used], counts[used] / scale) * scale
        before = int(counts.sum())
        for j in np.argsort(-repeats, kind="stable"):
            need = Counter(patterns[j])
            room = min(int(counts[n]) // k for n, k in need.items())
            times = min(room, int(np.rint(repeats[j])))
            if times:
                taken.append((patterns[j], times))
                for n, k in need.items():
                    counts[n] -= k * times
        if int(counts.sum()) > 0.98 * before:
            break
    return taken


def best_fit_decreasing(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Pack what is left by length, longest first, into the fullest sequences that have room.

    Sequences with the same content are one entry with a count.
    """
    open_by_room: dict[int, dict[tuple[int, ...], int]] = {}
    rooms = np.zeros(size + 1, bool)

    def put(content: tuple[int, ...], room: int, times: int) -> None:
        entry = open_by_room.setdefault(room, {})
        entry[content] = entry.get(content, 0) + times
        rooms[room] = True

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            fitting = np.flatnonzero(rooms[length:])
            if not len(fitting):
                per = size // length
                whole, rest = divmod(left, per)
                if whole:
                    put((length,) * per, size - per * length, whole)
                if rest:
                    put((length,) * rest, size - rest * length, 1)
                break
            room = int(fitting[0]) + length
            content, times = open_by_room[room].popitem()
            if not open_by_room[room]:
                rooms[room] = False
            per = min(room // length, left)
            full = min(times, left // per)
            put(content + (length,) * per, room - per * length, full)
            if times > full:
                put(content, room, times - full)
            left -= full * per
    return [(content, n) for entry in open_by_room.values() for content, n in entry.items()]


def packing_plan(counts: np.ndarray, size: int, most: int = MOST_PIECES) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths of a sequence, number of such sequences)`` for a histogram of piece lengths."""
    left = np.zeros(size + 1, np.int64)
    left[: len(counts)] = counts
    return fit_patterns(left, size, most) + best_fit_decreasing(left, size)


def plan_runs(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length the runs ``(first rank, first sequence, offset, pieces per sequence)``."""
    used: Counter = Counter()
    runs: dict[int, list] = {}
    sequence = 0
    for content, times in plan:
        offset = 0
        for length, per in Counter(content).items():
            runs.setdefault(length, []).append((used[length], sequence, offset, per))
            used[length] += per * times
            offset += per * length
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in runs.items()}


# --- Spark jobs -------------------------------------------------------------------------


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    size: int,
    end_id: int = 0,
    words: str = "dropped",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The pieces of every document; ``place`` numbers those of equal length in a task."""
    end = struct.pack("<I", end_id)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, seen, rows = TaskContext.get().partitionId(), Counter(), []
        schema = pa.schema(
            [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
             ("length", pa.int32()), ("ids_crc32", pa.int64()), ("part", pa.int32()),
             ("place", pa.int64())]
        )

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
            )

        for doc_id, ids in encode_batches(batches, WordEncoder.of_worker(tokenizer, words)):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * size)):
                data = ids[at : at + 4 * size]
                length = len(data) // 4
                rows.append((doc_id, piece, at // 4, length, zlib.crc32(data), part, seen[length]))
                seen[length] += 1
            if len(rows) >= 20_000:
                yield flush()
                rows.clear()
        if rows:
            yield flush()

    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    # Stored, so that the part and place of a piece never change.
    return stored(source.mapInArrow(run, PIECES), "pieces")


def place_pieces(pieces: DataFrame, size: int) -> DataFrame:
    """Give every piece its sequence and offset."""
    spark = pieces.sparkSession
    sizes = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    # One row per task and length; a length has at most as many rows as there are tasks.
    order = Window.partitionBy("length").orderBy("part")
    before = sizes.select(
        F.col("part").alias("in_part"),
        F.col("length").alias("of_length"),
        (F.sum("n").over(order) - F.col("n")).alias("before"),
    )
    counts = np.zeros(size + 1, np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    runs = spark.sparkContext.broadcast(plan_runs(packing_plan(counts, size)))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lengths = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                table = runs.value[length]
                row = table[np.searchsorted(table[:, 0], rank[at], "right") - 1]
                turn, slot = np.divmod(rank[at] - row[:, 0], row[:, 3])
                sequence[at] = row[:, 1] + turn
                offset[at] = row[:, 2] + slot * length
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(5)] + [pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    # The counts grow with the tasks, so they are shuffled however small they are.
    ranked = pieces.join(
        before.hint("merge"), (F.col("part") == F.col("in_part")) & (F.col("length") == F.col("of_length"))
    ).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("before") + F.col("place")).alias("rank"),
    )
    return ranked.mapInArrow(
        run,
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, words: str = "dropped") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return place_pieces(token_pieces(docs, tokenizer, size, end_id, words), size)
