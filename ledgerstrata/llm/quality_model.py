"""Quality scores from random-indexing word vectors and a two-layer network.

1. Every text is cut into units: runs of letters, of digits, of other marks. A
   unit belongs to one of ``WORDS`` hash buckets (upper-case units keep their
   case). A bucket has a sparse random index vector, and its word vector is the
   sum of the index vectors of the units around its occurrences, over the whole
   corpus. Each task adds up one matrix of fixed size; Spark sums the rows of all
   tasks. The result has ``WORDS x DIMENSIONS`` numbers whatever the corpus, so it
   may be sent to every task.
2. A document is the pooled vectors of all its units: weighted mean and spread,
   length of the mean, and likeness of neighbouring units.
3. A network with one hidden layer is trained in numpy on at most ``TRAIN_ROWS``
   labelled documents (those with the least hash of their id). A quarter of them
   is kept back to fit the temperature that calibrates its probabilities.

Labels, language, source and id are never inputs of a score.

* NULL and empty texts have the zero vector and get a score like any other.
* Documents without a label, with a NULL label or with contradicting labels are
  scored but not learned from. Without labels of both kinds the score is the
  share of label 1 among those there are, or 0.5.
* NULL ids count as the empty text for the folds. Repeated rows are scored each.
* No rows give no rows.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.llm.common import give_back, map_texts, remainder_of_id, spare_name, stored

WORDS = 1 << 15
DIMENSIONS = 64
WINDOW = 2
TRAIN_ROWS = 20_000
HIDDEN = 32
THRESHOLD = 0.3
FEATURES = 2 * DIMENSIONS + 4
UNITS = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0D]+")
PIECE = 1 << 15  # units that are vectors at the same time


# --- units and their index vectors --------------------------------------------------------


class Buckets(dict):
    """Bucket of a unit; the first ones met are remembered."""

    def __missing__(self, unit: bytes) -> int:
        key = unit if len(unit) > 1 and unit.isupper() else unit.lower()
        bucket = zlib.crc32(key) % WORDS
        if len(self) < 100_000 and len(unit) <= 32:
            self[unit] = bucket
        return bucket


def bucket_ids(text: bytes, buckets: Buckets) -> np.ndarray:
    return np.fromiter(map(buckets.__getitem__, UNITS.findall(text)), np.int64)


def index_places() -> tuple[np.ndarray, np.ndarray]:
    """Where each bucket's index vector is +1 and -1; the last entry, a gap, cancels itself."""
    rng = np.random.default_rng(20240229)
    plus = rng.integers(0, DIMENSIONS, WORDS + 1)
    minus = (plus + rng.integers(1, DIMENSIONS, WORDS + 1)) % DIMENSIONS
    plus[WORDS] = minus[WORDS] = 0
    return plus, minus


def add_contexts(total: np.ndarray, ids: np.ndarray, plus: np.ndarray, minus: np.ndarray) -> None:
    """Add the index vectors around every unit to the unit's row of ``total``."""
    for step in range(1, WINDOW + 1):
        for here, there in ((ids[:-step], ids[step:]), (ids[step:], ids[:-step])):
            row = here * DIMENSIONS
            total += np.bincount(row + plus[there], minlength=total.size)
            total -= np.bincount(row + minus[there], minlength=total.size)


def context_sums(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per bucket: its number of units ``n`` and its context sums ``d0..``, over all texts."""
    names = ["bucket", "n", *(f"d{i}" for i in range(DIMENSIONS))]

    def run(batches):
        import pyarrow as pa

        plus, minus = index_places()
        buckets = Buckets()
        total = np.zeros((WORDS + 1) * DIMENSIONS, np.int64)
        counts = np.zeros(WORDS + 1, np.int64)
        gap = np.full(WINDOW, WORDS, np.int64)
        held, size = [], 0

        def add():
            ids = np.concatenate(held)
            add_contexts(total, ids, plus, minus)
            counts[:] += np.bincount(ids, minlength=WORDS + 1)

        for batch in batches:
            for text in batch.column(0):
                ids = bucket_ids(text.as_py() or b"", buckets)
                held += [ids, gap]
                size += len(ids)
                if size >= 1 << 19:
                    add()
                    held, size = [], 0
        if held:
            add()
        seen = np.flatnonzero(counts[:WORDS])
        rows = total.reshape(-1, DIMENSIONS)[seen]
        columns = [seen, counts[seen], *rows.T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
        del total, counts, rows, columns, held, buckets
        give_back()

    schema = ", ".join(f"{name} long" for name in names)
    parts = docs.select(F.col(text_col).cast("string").cast("binary")).mapInArrow(run, schema)
    return parts.groupBy("bucket").agg(*[F.sum(name).alias(name) for name in names[1:]])


def word_vectors(sums: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Unit-length word vectors and pooling weights; at most ``WORDS`` rows reach the driver."""
    table = sums.toArrow()
    vectors = np.zeros((WORDS, DIMENSIONS))
    counts = np.zeros(WORDS)
    if table.num_rows:
        at = table.column("bucket").to_numpy()
        counts[at] = table.column("n").to_numpy()
        for i in range(DIMENSIONS):
            vectors[at, i] = table.column(f"d{i}").to_numpy()
        vectors[at] /= counts[at, None]
        # What all contexts share says nothing about a word.
        vectors[at] -= (vectors[at] * counts[at, None]).sum(0) / counts.sum()
        norm = np.sqrt((vectors**2).sum(1, keepdims=True))
        vectors = np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)
    share = counts / max(counts.sum(), 1.0)
    return vectors.astype(np.float32), (1e-3 / (1e-3 + share)).astype(np.float32)


def pooled(ids: np.ndarray, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The features of a document from the buckets of its units."""
    out = np.zeros(FEATURES, np.float32)
    if not len(ids):
        return out
    first, second = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    weight = near = far = 0.0
    for start in range(0, len(ids), PIECE):
        part = ids[start : start + PIECE + 2]
        rows, w = vectors[part], weights[part]
        own = min(PIECE, len(ids) - start)
        first += w[:own] @ rows[:own]
        second += w[:own] @ (rows[:own] ** 2)
        weight += float(w[:own].sum())
        near += float(np.einsum("ij,ij->", rows[1 : own + 1], rows[: len(rows[1 : own + 1])]))
        far += float(np.einsum("ij,ij->", rows[2 : own + 2], rows[: len(rows[2 : own + 2])]))
    mean = first / weight
    out[:DIMENSIONS] = mean
    out[DIMENSIONS : 2 * DIMENSIONS] = np.sqrt(np.maximum(second / weight - mean**2, 0))
    out[2 * DIMENSIONS :] = (
        np.sqrt((mean**2).sum()), near / len(ids), far / len(ids), np.log1p(len(ids))
    )
    return out


def pooling(shared):
    """A task's function from a text to the features of its document.

    ``shared`` is a broadcast of word vectors and pooling weights.
    """
    vectors, weights = shared.value
    buckets = Buckets()
    return lambda text: pooled(bucket_ids(text, buckets), vectors, weights)


# --- the network ---------------------------------------------------------------------------


class Network:
    """Standardised inputs, one hidden layer, a calibrated probability."""

    def __init__(self, x: np.ndarray, y: np.ndarray, keep: np.ndarray, epochs: int = 30):
        """Train on the rows where ``keep`` is false; fit the temperature on the others."""
        self.rate = float(y.mean()) if len(y) else 0.5
        self.fitted = False
        train, check = ~keep, keep
        if len(set(y[train].tolist())) < 2:
            return
        self.fitted = True
        self.mean = x[train].mean(0)
        self.scale = x[train].std(0) + 1e-6
        rng = np.random.default_rng(11)
        width = x.shape[1]
        self.weights = [
            rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN),
            rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1),
        ]
        self.temperature = 1.0
        self._train(self._inputs(x[train]), y[train].astype(float), epochs, rng)
        if check.sum() >= 20:
            self._calibrate(self._logits(self._inputs(x[check])), y[check].astype(float))

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh(x @ w1 + b1) @ w2 + b2[0]

    def _train(self, x, y, epochs: int, rng) -> None:
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step = 0
        for epoch in range(epochs):
            rate = 3e-3 * (1 - epoch / epochs) + 1e-4
            order = rng.permutation(len(x))
            for at in range(0, len(x), 128):
                rows = order[at : at + 128]
                w1, b1, w2, b2 = self.weights
                hidden = np.tanh(x[rows] @ w1 + b1)
                error = (1 / (1 + np.exp(-(hidden @ w2 + b2[0]))) - y[rows]) / len(rows)
                back = np.outer(error, w2) * (1 - hidden**2)
                slopes = [
                    x[rows].T @ back + 1e-4 * w1, back.sum(0),
                    hidden.T @ error + 1e-4 * w2, np.array([error.sum()]),
                ]
                step += 1
                for i, slope in enumerate(slopes):
                    first[i] += 0.1 * (slope - first[i])
                    second[i] += 0.001 * (slope**2 - second[i])
                    up = first[i] / (1 - 0.9**step)
                    down = np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8
                    self.weights[i] = self.weights[i] - rate * up / down

    def _calibrate(self, logits: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss, by golden-section search on its logarithm."""

        def loss(log_t: float) -> float:
            z = logits / np.exp(log_t)
            return float((np.logaddexp(0, z) - y * z).mean())

        low, high, ratio = -2.0, 3.0, (5**0.5 - 1) / 2
        for _ in range(40):
            a, b = high - ratio * (high - low), low + ratio * (high - low)
            low, high = (low, b) if loss(a) < loss(b) else (a, high)
        self.temperature = float(np.exp((low + high) / 2))

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.rate)
        return 1 / (1 + np.exp(-self._logits(self._inputs(x)) / self.temperature))


def _matrix(values) -> np.ndarray:
    joined = b"".join(values)
    return np.frombuffer(joined, np.float32).reshape(-1, FEATURES).astype(np.float64)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    held_out_fold: int = 0,
    train_rows: int = TRAIN_ROWS,
):
    """Word vectors of all of ``docs`` (as a broadcast) and the network trained on its labels.

    Labels are read only of documents whose crc32(id as text) modulo ``folds`` is
    not ``held_out_fold``.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(word_vectors(context_sums(docs, text_col)))
    named = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).alias("label"))
        .where(F.col("label").isin(0, 1) & (remainder_of_id(F.col("doc_id"), folds) != held_out_fold))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .drop("other")
    )
    chosen = stored(
        named.select("doc_id")
        .distinct()
        .join(known, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(train_rows),
        "training-ids",
    )

    def start():
        pool = pooling(shared)
        return lambda text: (pool(text).tobytes(),)

    # At most ``train_rows`` ids, so they may go to every task.
    texts = named.join(F.broadcast(chosen), "doc_id")
    sample = (
        map_texts(texts, "text", start, {"features": "binary"})
        .select("doc_id", "features", "label")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "features")
        .limit(train_rows)
        .collect()
    )
    x = _matrix(bytes(row["features"]) for row in sample)
    y = np.array([int(row["label"]) for row in sample])
    keep = np.array([zlib.crc32(b"keep %d" % row["doc_id"]) % 4 == 0 for row in sample], bool)
    network = Network(x, y, keep)
    # The driver goes on for as long as the application; it needs none of the rows again.
    del sample, x, y, keep
    give_back()
    return shared, network


def with_score(docs: DataFrame, shared, network: Network, text_col: str, score_col: str) -> DataFrame:
    """``docs`` with the probability of label 1 in ``score_col``."""

    def start():
        pool = pooling(shared)
        return lambda text: (float(network.probability(pool(text)[None].astype(np.float64))[0]),)

    return map_texts(docs, text_col, start, {score_col: "double"})


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    held_out_fold: int = 0,
    threshold: float = THRESHOLD,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    shared, network = fit_quality(
        docs, labels, id_col, text_col, label_col, folds, held_out_fold, train_rows
    )
    named = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return with_score(named, shared, network, "text", "score").select(
        "doc_id",
        (remainder_of_id(F.col("doc_id"), folds) == held_out_fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches ``threshold``."""
    text_col = options.get("text_col", "text")
    shared, network = fit_quality(docs, labels, **options)
    score = spare_name(docs, "quality_score")
    scored = with_score(docs, shared, network, text_col, score)
    return scored.where(F.col(score) >= threshold).select(*docs.columns)
