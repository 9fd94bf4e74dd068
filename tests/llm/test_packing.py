import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerstrata.llm import packing
from ledgerstrata.llm.common import vocabulary


def covered(plan):
    out = Counter()
    for content, times in plan:
        for length in content:
            out[length] += times
    return out


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=30))
def test_plans_use_every_piece_once(histogram):
    counts = np.zeros(65, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan = packing.packing_plan(counts, 64)
    assert covered(plan) == Counter(histogram)
    assert all(sum(content) <= 64 and times > 0 for content, times in plan)
    # Never worse than the bound of any-fit packing.
    total = sum(length * n for length, n in histogram.items())
    assert sum(times for _, times in plan) <= 2 * -(-total // 64) + 1


def test_plan_is_near_the_bound_and_does_not_grow():
    rng = np.random.default_rng(4)
    lengths = np.minimum(rng.lognormal(6.0, 1.1, 40_000).astype(int) + 1, 2048)
    counts = np.bincount(lengths, minlength=2049)
    bound = -(-int(lengths.sum()) // 2048)
    plan = packing.packing_plan(counts, 2048)
    assert sum(times for _, times in plan) <= 1.01 * bound
    larger = packing.packing_plan(counts * 1000, 2048)
    assert covered(larger) == Counter({n: int(c) * 1000 for n, c in enumerate(counts) if c})
    assert sum(times for _, times in larger) <= 1.01 * 1000 * bound
    assert len(larger) < 60_000


def test_patterns_are_used_as_often_as_fitted(monkeypatch):
    solve, propose = packing.nonnegative_least_squares, packing.candidate_patterns
    rounds, allowed = [], Counter()

    def proposing(counts, *rest):
        rounds.append((propose(counts, *rest), max(float(counts.max()), 1.0)))
        return rounds[-1][0]

    def solving(*args):
        fitted = solve(*args)
        patterns, scale = rounds[-1]
        for pattern, repeats in zip(patterns, np.rint(fitted * scale).astype(int).tolist()):
            allowed[pattern] += repeats
        return fitted

    monkeypatch.setattr(packing, "candidate_patterns", proposing)
    monkeypatch.setattr(packing, "nonnegative_least_squares", solving)
    rng = np.random.default_rng(4)
    counts = np.bincount(rng.integers(20, 1500, 40_000), minlength=2049)
    used = Counter()
    for pattern, times in packing.fit_patterns(counts, 2048):
        used[pattern] += times
    assert used and all(0 < times <= allowed[pattern] for pattern, times in used.items())
    assert any(not times for times in allowed.values())


def test_least_squares_find_an_exact_solution():
    matrix = np.array([[2.0, 0, 1], [0, 1, 1], [1, 1, 0]])
    want = np.array([3.0, 5.0, 7.0])
    assert np.allclose(packing.nonnegative_least_squares(matrix, matrix @ want, 5000), want, atol=1e-3)


def library_pieces(rows, size):
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    out = []
    for doc_id, text, *_ in rows:
        ids = np.array(one.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        out += [
            (doc_id, at // size, at, len(ids[at : at + size]), zlib.crc32(ids[at : at + size].tobytes()))
            for at in range(0, len(ids), size)
        ]
    return sorted(out, key=cases.key)


def test_awkward_rows(spark):
    docs = cases.documents(spark).repartition(4)
    for size in (2048, 16):
        got = packing.pack(docs, vocabulary("word_bpe_49k.json"), size).collect()
        assert sorted((tuple(r)[:5] for r in got), key=cases.key) == library_pieces(cases.ROWS, size)
        sequences = defaultdict(list)
        for r in got:
            sequences[r.sequence_id].append((r.offset, r.length))
        for places in sequences.values():
            places.sort()
            assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
            assert sum(n for _, n in places) <= size
        total = sum(r.length for r in got)
        assert len(sequences) <= -(-total // size) + 1
    assert packing.pack(cases.empty(spark), vocabulary("word_bpe_49k.json")).collect() == []
