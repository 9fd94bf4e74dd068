"""Near copies: SimHash and MinHash propose, the exact similarity decides.

Two texts are near copies if the sets of their lower-cased five-word shingles have
a Jaccard similarity of ``SIMILARITY`` or more; near copies of near copies are one
component. Two ways propose. SimHash fingerprints within three bits, found by BK-trees
(``simhash.py``), bring the closest copies together, whatever their sizes; copies of short
texts differ in more bits than that. MinHash bands bring the rest: texts that agree in one of ``BANDS`` bands of ``ROWS``
minima may be near copies. At a similarity of exactly 0.8 a pair shares no band with
a probability of 5e-7, and less above. What decides is the exact similarity.

How it scales: bands and fingerprint components are short keys, met in one aggregation,
and each text is linked to the least one of its band or component, never to all. The components of these links are cut
into blocks of bounded rows and shingles; two blocks meet in one task, which counts
shared shingles by matrix products and returns a spanning forest of the pairs it found.
Sets that are alike enough differ in size by a quarter at most, so a component of
several blocks is cut by size first (``SIZE_STEP``), and a block meets those of its own
and the two adjoining sizes only. So a component's size adds units and not rows per
task, and no pair is ever a row. Texts with equal sets are one node from the start.

* NULL and empty texts have no shingles and are copies of each other.
* A text of one to four words is a single shingle.
* Of a component the row with the least id stays, rows without id last; of rows with
  equal ids that with the least hash of its text. No rows give no rows.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.llm.common import give_back, only_rows, stored, word_blocks
from ledgerstrata.llm.components import connected_components
from ledgerstrata.llm.simhash import _merge, print_roots, simhash

SHINGLE = 5
# As a fraction, so that the comparison is one of whole numbers.
SIMILARITY = (4, 5)
BANDS, ROWS = 48, 6
BLOCK_TEXTS = 256
BLOCK_SHINGLES = 1 << 20
COLUMNS = 1 << 13
# Sizes by a factor of up to 5/4 apart fall into one class or two adjoining ones; a
# little more than 5/4, so that no rounding of a logarithm parts them.
SIZE_STEP = 1.26

_random = np.random.default_rng(42)
_FACTORS = _random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_OFFSETS = _random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_MIX = _random.integers(0, 1 << 64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    from xxhash import xxh64_intdigest

    found, tail = [], []
    for words in word_blocks(text.lower()):
        words = tail + words
        if len(words) >= shingle:
            runs = zip(*(words[i:] for i in range(shingle)))
            n = len(words) - shingle + 1
            found.append(np.unique(np.fromiter(map(xxh64_intdigest, map(b" ".join, runs), repeat(42)), "<u8", n)))
            tail = words[1 - shingle :]
        else:
            tail = words
    if found:
        return found[0] if len(found) == 1 else np.unique(np.concatenate(found))
    return np.array([xxh64_intdigest(b" ".join(tail), 42)] if tail else [], "<u8")


def bands(hashes: np.ndarray) -> np.ndarray:
    """One key per band; none for an empty set."""
    if not len(hashes):
        return hashes
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 1 << 10):
        part = _FACTORS[:, None] * short[None, at : at + (1 << 10)]
        part += _OFFSETS[:, None]
        np.minimum(least, part.min(1), out=least)
    keys = (least.reshape(BANDS, ROWS) * _MIX).sum(1, dtype=np.uint64)
    return keys ^ (np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def similar_pairs(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``(a, b)`` of all pairs of sets whose Jaccard similarity is high enough."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Only shingles of two sets or more can be shared.
    number = np.cumsum(count > 1) - 1
    mine = count[column] > 1
    owner, column = owner[mine], number[column[mine]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(sets), len(sets)))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        holds = np.zeros((len(sets), min(COLUMNS, int(column[b - 1]) - first + 1)), np.float32)
        holds[owner[a:b], column[a:b] - first] = 1
        shared += holds @ holds.T
    shared = np.rint(shared).astype(np.int64)
    part, whole = SIMILARITY
    return np.nonzero(np.triu(whole * shared >= part * (sizes[:, None] + sizes[None, :] - shared), 1))


def _text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_key"),
        F.col(text_col).cast("binary").alias("text"),
    )


def _node(hashes: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(hashes.tobytes(), 42)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, node, fp, shingles, bands)`` per row; equal sets have equal nodes.

    ``fp`` is the SimHash fingerprint of :mod:`simhash` as a signed long.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [text.as_py() or b"" for text in batch.column(2)]
            sets = [shingle_set(text) for text in texts]
            nodes = np.fromiter(map(_node, sets), "<u8", len(sets)).view("<i8")
            prints = np.fromiter(map(simhash, texts), "<u8", len(texts)).view("<i8")
            keys = [bands(hashes).view("<i8") for hashes in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(nodes), pa.array(prints),
                    pa.array([len(hashes) for hashes in sets], pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_key", "node", "fp", "shingles", "bands"],
            )
        give_back()

    return _text_rows(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, text_key long, node long, fp long, shingles long, bands array<long>"
    )


def _node_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(node, hashes)`` per row, the set as bytes."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sets = [shingle_set(text.as_py() or b"") for text in batch.column(2)]
            nodes = np.fromiter(map(_node, sets), "<u8", len(sets)).view("<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array([hashes.tobytes() for hashes in sets], pa.binary())],
                names=["node", "hashes"],
            )
        give_back()

    return _text_rows(docs, id_col, text_col).mapInArrow(run, "node long, hashes binary")


def _unit_links(rows: DataFrame) -> DataFrame:
    """Spanning forests ``(u, v)`` of the near copies inside units of ``(root, low, high, node, hashes)``."""

    def run(batches):
        import pyarrow as pa

        def forest(nodes, sets):
            labels = _merge(np.arange(len(nodes)), *similar_pairs(sets))
            nodes = np.array(nodes, np.int64)
            u, v = nodes, nodes[labels]
            return u[u != v], v[u != v]

        unit, nodes, sets, out = None, [], [], []
        for batch in batches:
            names = zip(*(batch.column(i).to_pylist() for i in range(4)))
            for at, (*key, node) in enumerate(names):
                if key != unit:
                    if len(nodes) > 1:
                        out.append(forest(nodes, sets))
                    unit, nodes, sets = key, [], []
                nodes.append(node)
                sets.append(np.frombuffer(batch.column(4)[at].as_py(), "<u8"))
        if len(nodes) > 1:
            out.append(forest(nodes, sets))
        if out:
            u, v = (np.concatenate(side) for side in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        give_back()

    unit = ["root", "low", "high"]
    return rows.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, "u long, v long").distinct()


def _print_proposals(rows: DataFrame) -> DataFrame:
    """Links ``(u, v)`` between the nodes whose fingerprints are one SimHash component.

    Texts that only differ in spaces or repeat their shingles share a node but not a
    fingerprint, so a node may take part in several components.
    """
    placed = stored(
        rows.select("node", "fp").distinct().join(print_roots(rows), "fp").select("node", F.col("root").alias("print")).distinct(),
        "copy-prints",
    )
    least = placed.groupBy("print").agg(F.min("node").alias("least"), F.count("*").alias("n")).where("n > 1")
    return placed.join(stored(least, "copy-print-least"), "print").select(F.col("node").alias("u"), F.col("least").alias("v"))


def near_copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, root)`` per row; rows with one root are near copies."""
    rows = stored(signatures(docs, id_col, text_col), "copy-signatures")
    nodes = stored(
        rows.groupBy("node").agg(
            F.min(F.struct("doc_id", "text_key")).alias("row"), F.first("shingles").alias("shingles"),
            F.first("bands").alias("bands"),
        ),
        "copy-nodes",
    )
    keyed = nodes.select("node", F.explode("bands").alias("band"))
    least = stored(
        keyed.groupBy("band").agg(F.min("node").alias("least"), F.count("*").alias("n")).where("n > 1"),
        "copy-bands",
    )
    proposed = keyed.join(least, "band").select(F.col("node").alias("u"), F.col("least").alias("v"))
    rough = connected_components(proposed.unionByName(_print_proposals(rows)))
    roots = stored(rough.unionByName(rough.select(F.col("root").alias("node"), "root").distinct()), "copy-roots")
    members = stored(nodes.select("node", "row", "shingles").join(roots, "node"), "copy-members")
    blocks = F.ceil(
        F.greatest(F.count("*") / BLOCK_TEXTS, F.sum("shingles") / BLOCK_SHINGLES)
    ).cast("int").alias("blocks")
    whole = members.groupBy("root").agg(blocks)
    step = F.floor(F.log("shingles") / F.lit(math.log(SIZE_STEP))).cast("int")
    sized = stored(
        members.join(whole, "root").select(
            "node", "root", "shingles", "row", F.when(F.col("blocks") > 1, step).otherwise(0).alias("size")
        ),
        "copy-sizes",
    )
    cut = stored(sized.groupBy("root", "size").agg(blocks), "copy-blocks")
    picked = only_rows(docs, members.select("row.*"), id_col, text_col)
    sets = stored(_node_sets(picked, id_col, text_col), "copy-sets")
    place = lambda size, block: (F.col(size).cast("long") * (1 << 32) + F.col(block))
    dealt = sized.join(cut, ["root", "size"]).select(
        "root", "node", F.col("size"), F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("mine"),
        F.explode(F.array(*[F.col("size") + k for k in (-1, 0, 1)])).alias("to_size"),
    )
    met = (
        dealt.join(cut.select("root", F.col("size").alias("to_size"), F.col("blocks").alias("others")), ["root", "to_size"])
        .select("*", F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("other"))
        .select("root", "node", place("size", "mine").alias("mine"), place("to_size", "other").alias("other"))
    )
    units = met.join(sets, "node").select(
        "root", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "node", "hashes"
    )
    found = stored(connected_components(_unit_links(units)), "copy-components")
    return rows.join(found, "node", "left").select("doc_id", "text_key", F.coalesce("root", "node").alias("root"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per component of near copies, with all its columns."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
    winners = near_copy_groups(docs, id_col, text_col).groupBy("root").agg(first)
    return only_rows(docs, winners.select("first.doc_id", "first.text_key"), id_col, text_col)
