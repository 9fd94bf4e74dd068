import math
import zlib
from collections import Counter

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerstrata.llm import interpolation as lm


def tokens_of(text):
    return [*cases.words((text or "").encode().lower().decode()), None]


def fold(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7


def brute(rows):
    """Scores of ``(doc_id, text)`` rows with plain dictionaries and the same folds."""
    docs = [(d, fold(d), tokens_of(t)) for d, t in rows]

    def counts(folds):
        one, two, n = Counter(), Counter(), 0
        for _, f, tokens in docs:
            if f in folds:
                n += 1
                one.update(tokens)
                two.update(zip([0, *tokens], tokens))
        return one, two, n

    def estimates(tokens, one, two, n):
        total = max(sum(one.values()), 1)
        for before, token in zip([0, *tokens], tokens):
            context = n if before == 0 else one[before]
            yield context, one[token] / total, two[before, token] / context if context else 0.0

    tuned = counts(set(range(7)) - {2, 3})
    evidence = Counter()
    for _, f, tokens in docs:
        if f == 3:
            for context, p1, p2 in estimates(tokens, *tuned):
                level = [-1 if p == 0 else round(-lm.RESOLUTION * math.log2(p)) for p in (p1, p2)]
                evidence[int(lm._bucket(np.array([context]))[0]), *level] += 1
    found = np.array([(*k, n) for k, n in sorted(evidence.items())], np.int64).reshape(-1, 4)
    weights = lm.learn_weights(found, len(tuned[0]))
    one, two, n = counts(set(range(7)) - {2})
    total, words = sum(one.values()), len(one)
    out = []
    for doc_id, f, tokens in docs:
        base = sum(math.log10((one[t] + 1) / (total + words + 1)) for t in tokens)
        score = 0.0
        for context, p1, p2 in estimates(tokens, one, two, n):
            mix = weights[int(lm._bucket(np.array([context]))[0])]
            score += math.log10(mix[0] / (words + 1) + mix[1] * p1 + mix[2] * p2)
        out.append((doc_id, f == 2, len(tokens), sum(one[t] > 0 for t in tokens), total, base, score))
    return sorted(out, key=cases.key)


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(map(tuple, got), key=cases.key), want):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-7)


def test_given_documents_and_block_sizes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    for size in (lm.BLOCK_BYTES, 60_000):
        same(lm.score(docs, block_bytes=size).collect(), want)
    held = [r for r in want if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_awkward_rows(spark):
    docs = cases.documents(spark)
    same(lm.score(docs).collect(), brute([(d, t) for d, t, *_ in cases.ROWS]))
    assert lm.score(cases.empty(spark)).collect() == []
    held = [i for i in range(200) if fold(i) == 2][:3]
    only = lm.score(cases.documents(spark, [(i, "never seen", "en", "a") for i in held])).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in only)


def test_probabilities_add_up():
    """Over the vocabulary and the unknown class, for seen and unseen contexts."""
    one, total = Counter({"a": 5, "b": 3, "c": 2}), 10
    two = Counter({("a", "b"): 3, ("a", "a"): 2})
    for context, before in ((5, "a"), (0, "new")):
        weights = lm.learn_weights(np.array([[lm._bucket(np.array([context]))[0], 4, 4 if context else -1, 50]]), 3)
        mix = weights[int(lm._bucket(np.array([context]))[0])]
        p = sum(mix[0] / 4 + mix[1] * one[w] / total + (mix[2] * two[before, w] / context if context else 0) for w in one)
        # Without a context the bigram part has no weight.
        assert p + mix[0] / 4 == pytest.approx(1, abs=1e-3)


def test_weights_recover_a_known_mixture():
    rng = np.random.default_rng(0)
    levels = rng.integers(0, 30, (200_000, 2))
    p = 2.0 ** (-levels / lm.RESOLUTION)
    keep = rng.random(len(p)) < 0.3 * p[:, 0] + 0.7 * p[:, 1]
    rows, n = np.unique(levels[keep], axis=0, return_counts=True)
    evidence = np.column_stack([np.full(len(rows), 9), rows, n])
    mix = lm.learn_weights(evidence, 10**9)[9]
    assert mix[0] < 0.01 and abs(mix[2] - 0.7) < 0.05
    assert np.allclose(lm.learn_weights(evidence, 10**9)[20], mix)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=50, unique=True),
       st.lists(st.integers(0, 2**40), max_size=50))
def test_codecs(keys, counts):
    keys = np.sort(np.array(keys, np.uint64))
    assert (lm.unpack_keys(lm.pack_keys(keys)) == keys).all()
    counts = np.array(counts, np.int64)
    assert (lm.unpack_counts(lm.pack_counts(counts)) == counts).all()
    bounds = lm._bounds(keys, 0, 7)
    assert bounds[0] == 0 and bounds[-1] == len(keys) and (np.diff(bounds) >= 0).all()
