"""SimHash near-duplicates with BK-trees.

A document's fingerprint is the bitwise majority of the XXH64 values of its
word shingles. Equal fingerprints are one node. For links within ``RADIUS`` bits
the 64 bits are cut into five blocks: two fingerprints that differ in at most
three bits agree on at least two whole blocks, so every pair meets in a shard
named by two blocks and their content (ten shards per fingerprint). Each shard
holds a BK-tree, whose children hang below their parent by integer Hamming
distance; a query follows only the edges whose distance lies within the radius
of its own distance to the parent.

The trees are not broadcast, because they grow with the corpus. A shard's tree
and the queries for it meet in one task instead, through a shuffle. A shard of
more than ``TREE_ROWS`` fingerprints is cut into several trees, and every block
of queries visits each tree, so a task's rows are bounded for any shard.

Links are not emitted as pairs: a task returns a spanning forest of what it
found, and ``components`` joins the forests.

* NULL and empty texts have fingerprint zero, which links like any other.
* A text of one or two words is a single shingle.
* NULL ``doc_id`` rows are kept; a component's id is the least id in it that is
  not NULL, or NULL if there is none.
* Repeated rows are returned as often as they come. No rows give no rows.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstrata.llm.common import give_back, only_rows, stored, word_blocks
from ledgerstrata.llm.components import connected_components

RADIUS = 3
TREE_ROWS = 1 << 14
FRONTIER = 1 << 21
# Five blocks of the 64 bits: (lowest bit, width).
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))


# --- fingerprints -----------------------------------------------------------------


def simhash(text: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    from xxhash import xxh64_intdigest

    ones, total, tail = np.zeros(64, np.int64), 0, []
    for words in word_blocks(text.lower()):
        words = tail + words
        if len(words) >= shingle:
            runs = zip(*(words[i:] for i in range(shingle)))
            n = len(words) - shingle + 1
            hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, runs), repeat(42)), "<u8", n)
            for at in range(0, n, 1 << 14):
                bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8), bitorder="little")
                ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
            total += n
        tail = words[1 - shingle :] if shingle > 1 else []
    if total == 0:
        if not tail:
            return 0
        return xxh64_intdigest(b" ".join(tail), 42)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3
) -> DataFrame:
    """``(doc_id, text_key, fp)`` per row, the fingerprint as a signed long."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            prints = np.fromiter(
                (simhash(text.as_py() or b"", shingle) for text in batch.column(2)),
                "<u8",
                batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view("<i8"))],
                names=["doc_id", "text_key", "fp"],
            )
        give_back()

    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_key"),
        F.col(text_col).cast("binary").alias("text"),
    )
    return source.mapInArrow(run, "doc_id long, text_key long, fp long")


# --- BK-trees ----------------------------------------------------------------------


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class BKForest:
    """One BK-tree per run of ``runs``; nodes are positions in ``prints``."""

    def __init__(self, prints: np.ndarray, runs: np.ndarray, first: np.ndarray):
        """``first`` holds each run's root position, in the order of the run numbers."""
        self.prints, self.roots = prints, first
        pending = np.arange(len(prints))
        pending = pending[first[runs] != pending]
        parent = first[runs[pending]]
        keys, children = [], []
        while len(pending):
            key = parent * 65 + _distance(prints[pending], prints[parent])
            order = np.argsort(key, kind="stable")
            key, pending = key[order], pending[order]
            new = np.r_[True, key[1:] != key[:-1]]
            child = pending[new]
            keys.append(key[new])
            children.append(child)
            # The others of the same parent and distance go below that child.
            parent = child[np.cumsum(new) - 1][~new]
            pending = pending[~new]
        key = np.concatenate([*keys, np.empty(0, np.int64)])
        order = np.argsort(key, kind="stable")
        self.keys = key[order]
        self.children = np.concatenate([*children, np.empty(0, np.int64)])[order]

    def search(self, queries: np.ndarray, runs: np.ndarray, radius: int):
        """Yield ``(query index, node)`` arrays within ``radius``, a tree level at a time."""
        query, node = np.arange(len(queries)), self.roots[runs]
        while len(query):
            distance = _distance(queries[query], self.prints[node])
            hit = distance <= radius
            yield query[hit], node[hit]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.keys, node * 65 + np.minimum(distance + radius, 64), "right")
            count = high - low
            starts = np.cumsum(count) - count
            at = np.arange(count.sum()) - np.repeat(starts, count) + np.repeat(low, count)
            query, node = np.repeat(query, count), self.children[at]


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the label sets that the links a-b connect; labels are least positions."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (labels[labels] != labels).any():
            labels = labels[labels]


def _central(prints: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Root position of each run: the member nearest to the bitwise majority in long runs."""
    roots = starts.copy()
    for i in np.flatnonzero(sizes >= 64):
        part = prints[starts[i] : starts[i] + sizes[i]]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
        centre = np.packbits(2 * bits.sum(0, dtype=np.int64) > sizes[i]).view(np.uint64)[0]
        roots[i] += int(np.argmin(np.bitwise_count(part ^ centre)))
    return roots


def shard_links(units: np.ndarray, prints: np.ndarray, in_tree, in_query, radius: int):
    """Spanning forest ``(print, print)`` of the links inside units.

    ``units`` are sorted unit numbers per row. Rows with ``in_tree`` make the
    unit's BK-tree, rows with ``in_query`` search it.
    """
    labels = np.arange(len(prints))
    tree_at = np.flatnonzero(in_tree)
    tree, tree_units = prints[tree_at], units[tree_at]
    present, starts, sizes = np.unique(tree_units, return_index=True, return_counts=True)
    if not len(present):
        return prints[:0], prints[:0]
    roots = _central(tree, starts, sizes)
    runs = np.searchsorted(present, tree_units)
    forest = BKForest(tree, runs, roots)

    query_at = np.flatnonzero(in_query & np.isin(units, present))
    query_runs = np.searchsorted(present, units[query_at])
    # What lies within the radius of the root is one component already. In a unit
    # whose queries are its tree, pairs of such rows need no search, and every
    # other pair is found by the query of its other row.
    hub = tree_at[roots[query_runs]]
    near = in_tree[query_at] & (_distance(prints[query_at], prints[hub]) <= radius)
    labels = _merge(labels, query_at[near], hub[near])
    tree_near = _distance(tree, tree[roots[runs]]) <= radius
    labels = _merge(labels, tree_at[tree_near], tree_at[roots[runs]][tree_near])
    query_at, query_runs = query_at[~near], query_runs[~near]

    # Queries per step so that the visited nodes stay within FRONTIER.
    load = np.cumsum(sizes[query_runs])
    cuts = np.searchsorted(load, np.arange(FRONTIER, (load[-1] if len(load) else 0) + FRONTIER, FRONTIER))
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(query_at)]):
        if a < b:
            at = query_at[a:b]
            for query, node in forest.search(prints[at], query_runs[a:b], radius):
                labels = _merge(labels, at[query], tree_at[node])
    linked = labels != np.arange(len(prints))
    u, v = prints[linked], prints[labels[linked]]
    return u[u != v], v[u != v]


# --- shards ---------------------------------------------------------------------------


def _shards(fp: Column) -> Column:
    """The ten (two blocks, content) names of a fingerprint, as longs."""
    parts = [F.shiftrightunsigned(fp, low).bitwiseAND((1 << width) - 1) for low, width in BLOCKS]
    names = []
    for i in range(len(BLOCKS)):
        for j in range(i + 1, len(BLOCKS)):
            content = F.shiftleft(parts[i], 13) + parts[j]
            names.append(content + F.lit((len(names) + 1) << 26).cast("long"))
    return F.array(*names)


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Links ``(u, v)`` that connect exactly the fingerprints within ``radius`` of each other.

    ``prints`` holds distinct fingerprints in ``fp`` and should be a stored table.
    """
    if radius > 3:
        raise ValueError("five blocks prove links up to three bits")
    keyed = prints.select("fp", F.explode(_shards(F.col("fp"))).alias("shard"))
    sizes = stored(keyed.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1"), "shards")
    trees = F.ceil(F.col("n") / tree_rows).cast("int")
    mine = F.pmod(F.xxhash64("fp"), trees).cast("int")
    rows = (
        keyed.join(sizes, "shard")
        .select("shard", "fp", mine.alias("mine"), F.explode(F.sequence(F.lit(0), trees - 1)).alias("other"))
        .select(
            "shard",
            F.least("mine", "other").alias("tree"),
            F.greatest("mine", "other").alias("block"),
            (F.col("mine") <= F.col("other")).alias("in_tree"),
            (F.col("mine") >= F.col("other")).alias("in_query"),
            "fp",
        )
    )

    def run(batches):
        import pyarrow as pa

        def forest(table):
            columns = [table.column(i).to_numpy() for i in range(3)]
            change = np.any([np.r_[True, c[1:] != c[:-1]] for c in columns], axis=0)
            units = np.cumsum(change) - 1
            flags = [table.column(i).to_numpy() for i in (3, 4)]
            fp = np.ascontiguousarray(table.column(5).to_numpy()).view("<u8")
            u, v = shard_links(units, fp, flags[0], flags[1], radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(u.view("<i8")), pa.array(v.view("<i8"))], names=["u", "v"]
            )

        # Whole units are handled together; the last one may go on in the next batch.
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < 200_000:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = [table.column(i)[-1].as_py() for i in range(3)]
            same = np.all([table.column(i).to_numpy() == x for i, x in enumerate(last)], axis=0)
            cut = int(np.argmax(same))
            if cut:
                yield forest(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield forest(pa.Table.from_batches(held).combine_chunks())

    unit = ["shard", "tree", "block"]
    return (
        rows.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, "u long, v long").distinct()
    )


def print_roots(prints: DataFrame, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """``(fp, low, root)`` per distinct fingerprint of ``(doc_id, fp)`` rows; those that
    are linked have one root, and ``low`` is the least id of the fingerprint."""
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "print-nodes")
    roots = connected_components(fingerprint_links(nodes, radius, tree_rows))
    named = nodes.join(roots, F.col("fp") == F.col("node"), "left")
    return stored(named.select("fp", "low", F.coalesce("root", "fp").alias("root")), "print-roots")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = RADIUS,
    tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, text_key.

    ``text_key`` hashes the text as it was given; it only names the row.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    named = print_roots(prints, radius, tree_rows)
    least = stored(named.groupBy("root").agg(F.min("low").alias("component_id")), "print-least")
    members = stored(named.join(least, "root").select("fp", "component_id"), "print-components")
    return prints.join(members, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "text_key",
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per component, with all its columns: that with the least id.

    A component whose ids are all NULL keeps one row per fingerprint.
    """
    groups = near_duplicates(docs, id_col, text_col)
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Rows that repeat the least id, and components whose ids are all NULL.
    group = F.when(F.col("component_id").isNull(), F.col("fingerprint"))
    winners = (
        first.groupBy("component_id", group.alias("print"))
        .agg(F.min("text_key").alias("text_key"))
        .select(F.col("component_id").alias("doc_id"), "text_key")
    )
    return only_rows(docs, winners, id_col, text_col)
