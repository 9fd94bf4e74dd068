"""Language-model scores by deleted interpolation of word n-grams.

The probability of a token mixes three maximum-likelihood estimates: uniform over
the vocabulary and one unknown class, unigram, and bigram. The mixture weights
depend on how often the context was seen (buckets of its count, one per octave)
and are learned by expectation-maximisation on counts held out from the
estimates: the documents of one training fold are scored with the counts of the
other folds.

n-gram tables grow with the corpus, so they are never broadcast. Documents are
dealt into blocks of bounded size. A block sends each of its distinct n-grams
once, with its count in the block, to the task that owns that range of n-gram
hashes, and gets back the corpus counts in the same order. Requests of all
blocks meet in the owner, so counting and looking up are the same pass, and a
frequent n-gram is one entry per block. Keys travel as sorted differences.

Tokens are named by 64-bit hashes and bigrams by 56 bits of one.

* NULL and empty texts are the single end token.
* NULL ids count as the empty text for the folds, and are returned.
* Rows that repeat an id are documents of their own.
* Without training documents every token is unknown and the score is that of
  the uniform part, log10(1 / (V + 1)) with V = 0. No rows give no rows.
"""

from __future__ import annotations

from math import ceil

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.llm.common import remainder_of_id, stored, word_blocks

BLOCK_BYTES = 16 << 20
BUCKETS = 40
EM_STEPS = 100
START = 0x9E3779B97F4A7C15  # the context before the first token
END = 0xD1B54A32D192ED03  # the token after the last word
COUNTED, TUNING, HELD_OUT = 0, 1, 2
RESOLUTION = 4  # steps per octave of the probabilities that the weights are learned from


# --- keys and small codecs ---------------------------------------------------------------


def _tokens(text: bytes) -> np.ndarray:
    from xxhash import xxh64_intdigest

    parts = []
    for words in word_blocks(text.lower()):
        parts.append(np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words)))
    parts.append(np.array([END], np.uint64))
    return np.concatenate(parts)


def _bigrams(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = (before * np.uint64(0xFF51AFD7ED558CCD)) ^ (token >> np.uint64(32))
        key = (key ^ (token << np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (key ^ (key >> np.uint64(32))) >> np.uint64(8)


class Block:
    """The tokens of some texts and their distinct n-grams in ascending order."""

    def __init__(self, texts):
        docs = [_tokens(text or b"") for text in texts]
        self.sizes = np.array([len(d) for d in docs], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        token = np.concatenate(docs)
        before = np.r_[np.uint64(START), token[:-1]]
        before[self.first] = START
        self.starts = np.zeros(len(token), bool)
        self.starts[self.first] = True
        found = [
            np.unique(keys, return_inverse=True, return_counts=True)
            for keys in (token, _bigrams(before, token))
        ]
        self.keys = [f[0] for f in found]
        self.at = [f[1] for f in found]
        self.counts = [f[2] for f in found]

    def counted(self, values: list[np.ndarray], documents: int):
        """Counts of token, context and bigram per token, from counts per distinct n-gram."""
        token = values[0][self.at[0]]
        context = np.r_[0, token[:-1]]
        context[self.starts] = documents
        return token, context, values[1][self.at[1]]


def _bounds(keys: np.ndarray, kind: int, ranges: int) -> np.ndarray:
    """Where each of ``ranges`` equal ranges of the key space starts in sorted ``keys``."""
    bits = 64 if kind == 0 else 56
    edges = [(r << bits) // ranges for r in range(1, ranges)]
    inner = np.searchsorted(keys, np.array(edges, np.uint64))
    return np.r_[0, inner, len(keys)]


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences of the least sufficient number of bytes."""
    steps = np.diff(keys, prepend=np.uint64(0))
    rest = max(1, (int(steps[1:].max()).bit_length() + 7) // 8) if len(steps) > 1 else 1
    # The first key is large, so it has a width of its own.
    body = steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :rest]
    return bytes([rest]) + int(steps[0]).to_bytes(8, "little") + body.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    width = data[0]
    body = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(body) + 1, 8), np.uint8)
    steps[1:, :width] = body
    steps = steps.view("<u8").ravel()
    steps[0] = int.from_bytes(data[1:9], "little")
    return np.cumsum(steps, dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte per count; those of 255 and more follow in full."""
    large = counts >= 255
    return (
        np.int64(len(counts)).tobytes()
        + np.minimum(counts, 255).astype(np.uint8).tobytes()
        + counts[large].astype("<i8").tobytes()
    )


def unpack_counts(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    counts = np.frombuffer(data, np.uint8, n, 8).astype(np.int64)
    large = counts == 255
    counts[large] = np.frombuffer(data, "<i8", offset=8 + n)
    return counts


# --- Spark jobs ----------------------------------------------------------------------------


def _request_rows(ranges: int):
    def run(table):
        import pyarrow as pa

        role = table.column("role")[0].as_py()
        name = table.column("block")[0].as_py()
        block = Block(table.column("text").to_pylist())
        shard, packed, counts = [], [], []
        for kind in (0, 1):
            bounds = _bounds(block.keys[kind], kind, ranges)
            for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                if a < b:
                    shard.append(2 * r + kind)
                    packed.append(pack_keys(block.keys[kind][a:b]))
                    counts.append(b"" if role == HELD_OUT else pack_counts(block.counts[kind][a:b]))
        n = len(shard)
        return pa.table({
            "shard": pa.array(shard, pa.int64()),
            "block": pa.array([name] * n, pa.int64()),
            "role": pa.array([role] * n, pa.int32()),
            "keys": pa.array(packed, pa.binary()),
            "counts": pa.array(counts, pa.binary()),
        })

    return run


def _answer(table):
    """Corpus counts of one range of keys for all blocks that asked."""
    import pyarrow as pa

    shard = table.column("shard")[0].as_py()
    blocks, roles = table.column("block").to_pylist(), table.column("role").to_pylist()
    keys = [unpack_keys(data.as_py()) for data in table.column("keys")]
    sizes = np.array([len(k) for k in keys])
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    total = {COUNTED: np.zeros(len(known), np.int64), TUNING: np.zeros(len(known), np.int64)}
    for role, data, start, size in zip(roles, table.column("counts"), starts, sizes):
        if role != HELD_OUT:
            # The keys of a block are distinct, so plain indexing adds each once.
            total[role][at[start : start + size]] += unpack_counts(data.as_py())
    train = total[COUNTED] + total[TUNING]
    whole, tuned = [], []
    for role, start, size in zip(roles, starts, sizes):
        mine = at[start : start + size]
        whole.append(pack_counts(train[mine]))
        tuned.append(pack_counts(total[COUNTED][mine]) if role == TUNING else None)
    n = len(blocks) + 1
    first = shard % 2 == 0
    return pa.table({
        "block": pa.array([*blocks, -1], pa.int64()),
        "shard": pa.array([shard] * n, pa.int64()),
        "train": pa.array([*whole, None], pa.binary()),
        "counted": pa.array([*tuned, None], pa.binary()),
        # Vocabulary and tokens, from the unigram ranges.
        "words": pa.array([None] * (n - 1) + [int((train > 0).sum()) * first], pa.int64()),
        "tokens": pa.array([None] * (n - 1) + [int(train.sum()) * first], pa.int64()),
        "counted_words": pa.array([None] * (n - 1) + [int((total[COUNTED] > 0).sum()) * first], pa.int64()),
        "counted_tokens": pa.array([None] * (n - 1) + [int(total[COUNTED].sum()) * first], pa.int64()),
    })


ANSWER = (
    "block long, shard long, train binary, counted binary, words long, tokens long, "
    "counted_words long, counted_tokens long"
)


def _answers_for(table, column: str) -> list[np.ndarray]:
    """Counts per distinct unigram and bigram of a block, in the block's order."""
    rows = sorted(zip(table.column("shard").to_pylist(), table.column(column)), key=lambda x: x[0])
    return [
        np.concatenate([unpack_counts(data.as_py()) for shard, data in rows if shard % 2 == kind])
        for kind in (0, 1)
    ]


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the whole part of log2 of its count."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


def _evidence(words: int, tokens: int, documents: int):
    """Held-out tokens by context bucket and by the (rounded) estimates they get."""

    def level(p: np.ndarray) -> np.ndarray:
        out = np.full(len(p), -1, np.int64)
        some = p > 0
        out[some] = np.rint(-RESOLUTION * np.log2(p[some])).astype(np.int64)
        return out

    def run(left, right):
        import pyarrow as pa

        if not left.num_rows:
            rows = np.empty((0, 3), np.int64)
            n = np.empty(0, np.int64)
        else:
            block = Block(left.column("text").to_pylist())
            token, context, bigram = block.counted(_answers_for(right, "counted"), documents)
            unigram = token / max(tokens, 1)
            following = np.divide(bigram, context, out=np.zeros(len(bigram)), where=context > 0)
            rows = np.stack([_bucket(context), level(unigram), level(following)], 1)
            rows, n = np.unique(rows, axis=0, return_counts=True)
        return pa.table({
            "bucket": rows[:, 0], "unigram": rows[:, 1], "bigram": rows[:, 2], "n": n.astype(np.int64)
        })

    return run


def learn_weights(evidence: np.ndarray, words: int, steps: int = EM_STEPS) -> np.ndarray:
    """Mixture weights per bucket from rows ``(bucket, unigram level, bigram level, n)``.

    A bucket without evidence takes the weights of the next lower one that has some.
    """

    def probability(level):
        return np.where(level < 0, 0.0, 2.0 ** (-level / RESOLUTION))

    weights = np.tile([0.1, 0.9, 0.0], (BUCKETS, 1))
    for bucket in range(BUCKETS):
        rows = evidence[evidence[:, 0] == bucket]
        if not len(rows):
            if bucket > 1:
                weights[bucket] = weights[bucket - 1]
            elif bucket == 1:
                weights[bucket] = [0.1, 0.6, 0.3]
            continue
        parts = np.stack(
            [np.full(len(rows), 1.0 / (words + 1)), probability(rows[:, 1]), probability(rows[:, 2])], 1
        )
        n = rows[:, 3].astype(float)
        mix = np.array([1 / 3, 1 / 3, 1 / 3])
        for _ in range(steps):
            share = parts * mix
            share /= share.sum(1, keepdims=True)
            # One token of prior evidence each keeps every weight positive.
            gained = (share * n[:, None]).sum(0) + [1e-3, 1e-3, 0.0]
            mix = gained / gained.sum()
        weights[bucket] = mix
    return weights


def _scores(words: int, tokens: int, documents: int, weights: np.ndarray, held_out_id: int):
    def run(left, right):
        import pyarrow as pa

        if not left.num_rows:
            return pa.table({
                "doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()),
                "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()),
                "train_tokens": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()),
                "score": pa.array([], pa.float64()),
            })
        block = Block(left.column("text").to_pylist())
        token, context, bigram = block.counted(_answers_for(right, "train"), documents)
        mix = weights[_bucket(context)]
        following = np.divide(bigram, context, out=np.zeros(len(bigram)), where=context > 0)
        p = mix[:, 0] / (words + 1) + mix[:, 1] * token / max(tokens, 1) + mix[:, 2] * following
        base = np.log10((token + 1.0) / (tokens + words + 1))
        n = left.num_rows
        return pa.table({
            "doc_id": left.column("doc_id"),
            "held_out": pa.array(np.asarray(left.column("role")) == held_out_id),
            "n_tokens": block.sizes,
            "n_known": np.add.reduceat((token > 0).astype(np.int64), block.first),
            "train_tokens": pa.array([tokens] * n, pa.int64()),
            "base_score": np.add.reduceat(base, block.first),
            "score": np.add.reduceat(np.log10(p), block.first),
        })

    return run


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 7,
    held_out_fold: int = 2,
    tuning_fold: int = 3,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigram) and score (the model), both log10.

    The fold of a document is crc32 of its id as text, modulo ``folds``. The model
    counts all documents outside ``held_out_fold``; its weights are learned on
    ``tuning_fold`` with the counts of the others.
    """
    fold = remainder_of_id(F.col(id_col), folds)
    role = (
        F.when(fold == held_out_fold, HELD_OUT).when(fold == tuning_fold, TUNING).otherwise(COUNTED)
    )
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
        role.cast("int").alias("role"),
    )
    # One row per role: its documents and bytes.
    found = {
        r["role"]: (r["n"], r["size"])
        for r in source.groupBy("role")
        .agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
        .collect()
    }
    blocks = {r: max(1, ceil(found.get(r, (0, 0))[1] / block_bytes)) for r in (0, 1, 2)}
    ranges = max(8, sum(blocks.values()))
    dealt = F.pmod(
        F.xxhash64("doc_id", "text"),
        F.when(F.col("role") == COUNTED, blocks[COUNTED])
        .when(F.col("role") == TUNING, blocks[TUNING])
        .otherwise(blocks[HELD_OUT]),
    )
    dealt_docs = source.select("*", (dealt * 3 + F.col("role")).alias("block"))

    requests = dealt_docs.groupBy("block").applyInArrow(
        _request_rows(ranges), "shard long, block long, role int, keys binary, counts binary"
    )
    answers = stored(requests.groupBy("shard").applyInArrow(_answer, ANSWER), "ngram-counts")
    words, tokens, counted_words, counted_tokens = (
        x or 0
        for x in answers.where("block = -1")
        .agg(F.sum("words"), F.sum("tokens"), F.sum("counted_words"), F.sum("counted_tokens"))
        .first()
    )
    counted_docs = found.get(COUNTED, (0, 0))[0]
    train_docs = counted_docs + found.get(TUNING, (0, 0))[0]

    tuning = dealt_docs.where(F.col("role") == TUNING).select("block", "text")
    asked = answers.where((F.col("block") % 3 == TUNING)).select("block", "shard", "counted")
    evidence = (
        tuning.groupBy("block")
        .cogroup(asked.groupBy("block"))
        .applyInArrow(
            _evidence(counted_words, counted_tokens, counted_docs),
            "bucket long, unigram long, bigram long, n long",
        )
        .groupBy("bucket", "unigram", "bigram")
        .agg(F.sum("n").alias("n"))
    )
    # Bounded by buckets and levels, whatever the corpus.
    rows = np.array([tuple(r) for r in evidence.collect()], np.int64).reshape(-1, 4)
    weights = learn_weights(rows, counted_words)

    replies = answers.where("block >= 0").select("block", "shard", "train")
    return (
        dealt_docs.groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(
            _scores(words, tokens, train_docs, weights, HELD_OUT),
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )
