"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

1. A word is a run of non-space characters, lower-cased, with marks at its ends cut
   off. It has its own bucket and one per character n-gram of ``GRAMS`` of the word
   in ``<`` and ``>``; its vector is the mean of the vectors of those buckets. A
   misspelt word that was never seen still shares most of its n-grams, so it lies
   beside the word it stands for.
2. A text is read in passages of ``PASSAGE`` words (the last one ends with the text).
   A passage is the mean of the vectors of its words; a shorter text is filled up with
   zero vectors. A softmax over the two classes is linear in that mean. The passage
   with the highest probability speaks for its text, so an insult weighs the same in a
   short text as in a very long one.
3. Bucket vectors and softmax are trained together, in numpy, on at most
   ``TRAIN_ROWS`` labelled documents, half of each class (those with the least hash of
   their id), with ``TRAIN_PASSAGES`` passages each. Buckets that fewer than
   ``LEAST_SHARE`` of these texts (or ``LEAST_TEXTS``) hold stay at zero. The share of each class among all
   labelled documents then sets the intercept, so that scores fit the corpus and not
   the sample.
4. The softmax is linear, so a passage needs one number per word. Tasks get one number
   per bucket (``BUCKETS`` of them whatever the corpus) and score every whole text
   alone: nothing is shuffled.

Labels, language, source and id are never inputs of a score.

* NULL texts and texts without a word have zero vectors and get the score of the
  intercept alone.
* Documents without a label, with a NULL label or with contradicting labels are
  scored but not learned from. Without labels of both kinds every score is the share
  of label 1 among those there are, or 0.5.
* NULL ids count as the empty text for the folds. Repeated rows are scored each.
* No rows give no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerstrata.llm.common import give_back, remainder_of_id, spare_name, stored

BUCKETS = 1 << 17
DIMENSIONS = 16
GRAMS = (3, 4, 5)
PASSAGE = 64
TRAIN_ROWS = 6_000
TRAIN_PASSAGES = 32
LONGEST = 1_000  # characters of a word that may be learned from; longer ones are only scored
LEAST_SHARE = 0.02
LEAST_TEXTS = 5
EPOCHS = 8
BATCH = 32
RATE = 1.0
THRESHOLD = 0.3
BLOCK = 1 << 17  # characters that are arrays at the same time

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_MARK = np.zeros(128, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


# --- words and their buckets ---------------------------------------------------------


def lowered(text: bytes) -> str:
    return text.decode("utf-8", "replace").lower()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0]+1, ..`` of every range one after the other."""
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return shift + np.arange(len(shift))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Subwords:
    """The words of a text and the buckets of each, for all words at once.

    The hash of a run of characters is a difference of running sums, so every
    n-gram of every word costs a few operations on whole arrays.
    """

    def __init__(self):
        self.up, self.down = _powers(_BASE, 2 * BLOCK), _powers(_BACK, 2 * BLOCK)

    @staticmethod
    def _edges(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        space = (points == 32) | ((points >= 9) & (points <= 13))
        edges = np.flatnonzero(np.diff(np.r_[True, space, True]))
        return space, edges[::2], edges[1::2]

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each word starts; the buckets of all words and which word each belongs to."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        space, starts, ends = self._edges(points)
        if not len(starts):
            return starts, np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Marks at the ends of a word are cut off, unless it has nothing else.
        solid = np.flatnonzero(~space & ~(_MARK[np.minimum(points, 127)] & (points < 127)))
        low, high = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
        body = np.r_[solid, 0]
        first = np.where(high > low, body[np.minimum(low, len(solid))], starts)
        last = np.where(high > low, body[high - 1] + 1, ends)
        inner = last - first
        framed = np.empty(int((inner + 2).sum()), np.uint64)
        at = np.cumsum(inner + 2) - (inner + 2)
        framed[at] = ord("<")
        framed[at + inner + 1] = ord(">")
        framed[_ranges(at + 1, inner)] = points[_ranges(first, inner)]
        if len(framed) >= len(self.up):
            self.up, self.down = _powers(_BASE, 2 * len(framed)), _powers(_BACK, 2 * len(framed))
        run = np.r_[np.uint64(0), np.cumsum(framed * self.up[: len(framed)], dtype=np.uint64)]
        word = np.repeat(np.arange(len(starts)), inner + 2)
        found = [(run[at + inner + 2] - run[at]) * self.down[at]]
        owner = [np.arange(len(starts))]
        for n in GRAMS:
            whole = np.flatnonzero(word[: len(word) - n + 1] == word[n - 1 :]) if len(word) >= n else at[:0]
            found.append((run[whole + n] - run[whole]) * self.down[whole] + np.uint64(n))
            owner.append(word[whole])
        hashes = np.concatenate(found) * _SPREAD
        hashes ^= hashes >> np.uint64(32)
        return starts, ((hashes * _SPREAD) >> np.uint64(47)).astype(np.int64), np.concatenate(owner)


def blocks(text: str):
    """``text`` cut at spaces about every ``BLOCK`` characters."""
    start = 0
    while len(text) - start > BLOCK:
        # Only the six separators are ASCII white space of one kind: look for the nearest of them.
        cut = min((at for at in (text.find(c, start + BLOCK) for c in " \t\n\v\f\r") if at >= 0), default=-1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def passage_starts(n: int) -> np.ndarray:
    """Where the passages of ``n`` words start; the last one ends with the text."""
    starts = np.arange(0, max(n - PASSAGE, 0) + 1, PASSAGE)
    return starts if starts[-1] + PASSAGE >= n else np.r_[starts, n - PASSAGE]


def sample_passages(text: bytes) -> list[list[str]]:
    """The passages of a text to learn from; of more than ``TRAIN_PASSAGES`` evenly spread ones."""
    words = re.findall("[^ \t\n\v\f\r]+", lowered(text))
    starts = passage_starts(len(words))
    if len(starts) > TRAIN_PASSAGES:
        starts = starts[np.linspace(0, len(starts) - 1, TRAIN_PASSAGES).astype(np.int64)]
    return [[w for w in words[at : at + PASSAGE] if len(w) <= LONGEST] for at in starts.tolist()]


# --- the model -----------------------------------------------------------------------


def _sum_runs(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of the rows of ``values`` that carry them."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(values[order], starts, axis=0)


class SubwordSoftmax:
    """Bucket vectors ``E`` and a softmax ``W``, ``b`` over the mean vector of a passage."""

    def __init__(self, texts: Iterable[list[list[str]]], labels: np.ndarray, share: float | None = None):
        """Train on the passages of texts; ``share`` is that of label 1 in the corpus."""
        self.rate = share if share is not None else float(labels.mean()) if len(labels) else 0.5
        self.fitted = len(set(labels.tolist())) == 2
        self.of_bucket = np.zeros(BUCKETS, np.float32)
        self.intercept = 0.0
        if self.fitted:
            self._prepare(texts)
            self._train(labels.astype(np.int64))
            drawn = float(labels.mean())
            prior = np.log(self.rate / (1 - self.rate)) - np.log(drawn / (1 - drawn))
            self.intercept = float(self.b[1] - self.b[0] + prior)
            self.of_bucket = (self.E @ (self.W[:, 1] - self.W[:, 0])).astype(np.float32)

    def _prepare(self, texts) -> None:
        """Texts, passages, words and buckets as flat arrays with starts and sizes."""
        number: dict[str, int] = {}
        passages, counts = [], []
        for text in texts:  # one text at a time, so that few words are Python objects
            passages += [np.array([number.setdefault(w, len(number)) for w in p], np.int32) for p in text]
            counts.append(len(text))
        self.text_start = np.r_[0, np.cumsum(counts)]
        self.size = np.array([len(p) for p in passages])
        self.start = np.r_[0, np.cumsum(self.size)]
        self.words = np.concatenate(passages)
        del passages
        cut = Subwords()
        buckets, owners, vocabulary = [], [], list(number)
        words = len(number)
        del number
        for at in range(0, len(vocabulary), 4096):
            _, bucket, owner = cut(" ".join(vocabulary[at : at + 4096]))
            buckets.append(bucket.astype(np.int32))
            owners.append((owner + at).astype(np.int32))
        del vocabulary
        order = np.argsort(np.concatenate(owners), kind="stable")
        self.word_bucket = np.concatenate(buckets)[order]
        self.word_size = np.bincount(np.concatenate(owners), minlength=words)
        self.word_start = np.cumsum(self.word_size) - self.word_size
        # What only a few texts hold would be learned by heart; such buckets stay at zero.
        owner = np.repeat(np.repeat(np.arange(len(counts)), counts), self.size)
        held = np.unique(owner * words + self.words) % words
        of_word = np.bincount(held, minlength=words)
        of_bucket = np.bincount(self.word_bucket, np.repeat(of_word, self.word_size), BUCKETS)
        least = max(LEAST_TEXTS, LEAST_SHARE * len(counts))
        self.known = (of_bucket >= least).astype(np.float32)[:, None]

    def _passage_logits(self) -> np.ndarray:
        of_bucket = self.E @ (self.W[:, 1] - self.W[:, 0])
        of_word = np.add.reduceat(of_bucket[self.word_bucket], self.word_start) / self.word_size
        total = np.r_[0, np.cumsum(of_word[self.words], dtype=np.float64)]
        return (total[self.start[1:]] - total[self.start[:-1]]) / PASSAGE

    def _train(self, labels: np.ndarray) -> None:
        rng = np.random.default_rng(12)
        self.E = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS * self.known
        self.W = rng.normal(0, DIMENSIONS**-0.5, (DIMENSIONS, 2)).astype(np.float32)
        self.b = np.zeros(2, np.float32)
        # Squared slopes met so far, per bucket and per weight, set the step sizes.
        self.seen = [np.full(BUCKETS, 1e-12, np.float32), np.full_like(self.W, 1e-8), np.full(2, 1e-8)]
        count = np.diff(self.text_start)
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS) + 0.02
            logits = self._passage_logits()
            # The passage that speaks most for label 1 stands for its text.
            best = np.array([a + logits[a:b].argmax() for a, b in zip(self.text_start[:-1], self.text_start[1:])])
            if epoch < 1:
                best = self.text_start[:-1] + rng.integers(0, count)
            order = rng.permutation(len(labels))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                rows = rows[self.size[best[rows]] > 0]
                if len(rows):
                    self._step(best[rows], labels[rows], rate)

    def _step(self, passages: np.ndarray, labels: np.ndarray, rate: float) -> None:
        sizes = self.size[passages]
        places = _ranges(self.start[passages], sizes)
        used, word = np.unique(self.words[places], return_inverse=True)
        parts = self.word_size[used]
        buckets = self.word_bucket[_ranges(self.word_start[used], parts)]
        vectors = np.add.reduceat(self.E[buckets], np.r_[0, np.cumsum(parts)[:-1]], axis=0) / parts[:, None]
        mean = np.add.reduceat(vectors[word], np.r_[0, np.cumsum(sizes)[:-1]], axis=0) / PASSAGE
        logits = mean @ self.W + self.b
        error = np.exp(logits - logits.max(1, keepdims=True))
        error /= error.sum(1, keepdims=True)
        error[np.arange(len(labels)), labels] -= 1
        error /= len(labels)

        seen_E, seen_W, seen_b = self.seen
        _, to_word = _sum_runs(np.repeat(error @ self.W.T, sizes, axis=0) / PASSAGE, word)
        bucket, slope = _sum_runs(np.repeat(to_word / parts[:, None], parts, axis=0), buckets)
        seen_E[bucket] += (slope**2).mean(1)
        self.E[bucket] -= self.known[bucket] * (rate / DIMENSIONS**0.5) * slope / np.sqrt(seen_E[bucket])[:, None]
        slope = mean.T @ error
        seen_W += slope**2
        self.W -= 0.2 * rate * slope / np.sqrt(seen_W)
        slope = error.sum(0)
        seen_b += slope**2
        self.b -= (0.2 * rate * slope / np.sqrt(seen_b)).astype(np.float32)

    def scorer(self) -> SubwordSoftmax:
        """A copy that holds what scoring needs beside ``of_bucket``."""
        small = object.__new__(SubwordSoftmax)
        small.rate, small.fitted, small.intercept = self.rate, self.fitted, self.intercept
        return small

    def score(self, texts: list[bytes], of_bucket: np.ndarray, cut: Subwords) -> np.ndarray:
        """The probability of label 1 of each text; its strongest passage speaks for it."""
        if not self.fitted:
            return np.full(len(texts), self.rate)
        out = np.empty(len(texts))
        for first, last, values, counts in _word_values(texts, of_bucket, cut):
            total = np.r_[0, np.cumsum(values, dtype=np.float64)]
            place = np.cumsum(counts) - counts
            for i, (at, n) in enumerate(zip(place.tolist(), counts.tolist()), first):
                starts = at + passage_starts(n)
                ends = np.minimum(starts + PASSAGE, at + n)
                out[i] = (total[ends] - total[starts]).max() / PASSAGE
        return 1 / (1 + np.exp(-np.clip(out + self.intercept, -500, 500)))


def _word_values(texts: list[bytes], of_bucket: np.ndarray, cut: Subwords):
    """``(first, last, values, counts)``: one number per word of the texts from first to last."""

    def values(text: str):
        starts, bucket, owner = cut(text)
        n = len(starts)
        sums = np.bincount(owner, of_bucket[bucket], n) / np.maximum(np.bincount(owner, minlength=n), 1)
        return starts, sums

    at = 0
    while at < len(texts):
        some, size, last = [], 0, at
        while last < len(texts) and (not some or size + len(texts[last]) <= BLOCK):
            some.append(lowered(texts[last]))
            size += len(texts[last]) + 1
            last += 1
        if len(some) == 1:
            found = [values(block)[1] for block in blocks(some[0])]
            counts = np.array([sum(map(len, found))])
            yield at, last, np.concatenate(found), counts
        else:
            starts, found = values("\n".join(some))
            ends = np.cumsum([len(t) + 1 for t in some])
            counts = np.diff(np.r_[0, np.searchsorted(starts, ends)])
            yield at, last, found, counts
        at = last


# --- on Spark ------------------------------------------------------------------------


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 4,
    held_out_fold: int = 2,
    train_rows: int = TRAIN_ROWS,
) -> SubwordSoftmax:
    """The model trained on labels of documents outside the held-out fold.

    At most ``train_rows`` documents with ``TRAIN_PASSAGES`` passages each reach the
    driver.
    """
    known = stored(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).alias("label"))
        .where(F.col("label").isin(0, 1) & (remainder_of_id(F.col("doc_id"), folds) != held_out_fold))
        .groupBy("doc_id")
        .agg(F.min("label").cast("int").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .drop("other"),
        "toxic-labels",
    )
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    share = counts.get(1, 0) / sum(counts.values()) if counts else None
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    named = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            rows = ["\n".join(map(" ".join, sample_passages(text.as_py() or b""))) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(rows, pa.string())],
                names=["doc_id", "label", "passages"],
            )

    sample = []
    for label in (0, 1):
        # At most half of ``train_rows`` ids, so they may go to every task.
        chosen = known.where(F.col("label") == label).orderBy(*order).limit(train_rows // 2)
        sample += (
            named.join(F.broadcast(chosen), "doc_id")
            .select("doc_id", "text", "label")
            .mapInArrow(cut, "doc_id long, label int, passages string")
            .orderBy(*order, "passages")
            .limit(train_rows // 2)
            .collect()
        )
    passages = ([p.split(" ") if p else [] for p in row["passages"].split("\n")] for row in sample)
    return SubwordSoftmax(passages, np.array([row["label"] for row in sample]), share)


def with_toxicity(
    docs: DataFrame, model: SubwordSoftmax, text_col: str = "text", score_col: str = "score"
) -> DataFrame:
    """``docs`` with the probability of label 1 in ``score_col``; every row is scored by itself."""
    shared = docs.sparkSession.sparkContext.broadcast(model.of_bucket)
    small = model.scorer()

    def run(batches):
        import pyarrow as pa

        of_bucket, cut = shared.value, Subwords()
        for batch in batches:
            texts = [text.as_py() or b"" for text in batch.column(at).cast(pa.binary())]
            scores = small.score(texts, of_bucket, cut)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, score_col]
            )
        give_back()

    if docs.schema[text_col].dataType != StringType():
        docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    at = docs.columns.index(text_col)
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(score_col, DoubleType())]))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 4,
    held_out_fold: int = 2,
    threshold: float = THRESHOLD,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit_toxicity(docs, labels, id_col, text_col, label_col, folds, held_out_fold, train_rows)
    named = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return with_toxicity(named, model).select(
        "doc_id",
        (remainder_of_id(F.col("doc_id"), folds) == held_out_fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score stays below ``threshold``."""
    score = spare_name(docs, "toxicity")
    scored = with_toxicity(docs, fit_toxicity(docs, labels, **options), options.get("text_col", "text"), score)
    return scored.where(F.col(score) < threshold).select(*docs.columns)
