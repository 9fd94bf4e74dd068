import random

import cases
import numpy as np

from ledgerstrata.llm import near_copies, stages


def brute_set(text):
    words = cases.lower(text).split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def brute_roots(sets):
    """Least position of the component of every set."""
    holders = {}
    for i, s in enumerate(sets):
        for x in s or {None}:
            holders.setdefault(x, []).append(i)
    near = [[j for j in {j for x in s or {None} for j in holders[x]} if similar(s, sets[j])] for s in sets]
    label = list(range(len(sets)))
    while (moved := [min(label[j] for j in near[i]) for i in range(len(sets))]) != label:
        label = moved
    return label


def expected(rows):
    rows = sorted(rows)
    label = brute_roots([brute_set(text) for _, text in rows])
    return {rows[i][0] for i in range(len(rows)) if label[i] == i}


def test_stage_matches_all_pairs_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id for r in stages.simhash_near_dedup(spark, docs, "").collect()}
    assert got == want
    # A text of 60 shingles and a copy five bits apart, which the three-bit rule kept.
    assert len({2, 56, 914} & got) == 1


def test_one_group_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK_TEXTS", 7)
    rng = random.Random(4)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.sample(range(120), rng.choice((0, 1, 2, 3, 5, 8))):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in near_copies.drop_similar(docs).collect()} == expected(rows)


def test_sizes_of_one_group_far_apart(spark, monkeypatch):
    """Texts that grow by steps, so that a component spans many sizes and blocks."""
    monkeypatch.setattr(near_copies, "BLOCK_TEXTS", 5)
    words = [f"w{i}" for i in range(900)]
    # 20 and 25 shingles, 16 and 20: exactly a quarter apart.
    lengths = [n for n in range(20, 900, 9)] + [20, 24, 29, 36, 44, 54]
    rows = [(i, " ".join(words[:n])) for i, n in enumerate(lengths)]
    rows += [(1000 + i, " ".join(words[300 : 300 + n])) for i, n in enumerate((40, 41, 50, 70))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in near_copies.drop_similar(docs).collect()} == expected(rows)


def test_threshold_is_exact():
    words = [f"w{i}" for i in range(40)]
    sets = [near_copies.shingle_set(" ".join(w).encode()) for w in (words, words[:33], words[:32], words[:33])]
    # 36, 29 and 28 shingles: 29/36 is above 0.8, 28/36 below.
    a, b = near_copies.similar_pairs(sets)
    assert set(zip(a.tolist(), b.tolist())) == {(0, 1), (0, 3), (1, 2), (1, 3), (2, 3)}
    assert near_copies.similar_pairs([np.array([], "<u8"), sets[0]])[0].size == 0


def test_awkward_rows(spark):
    docs = cases.documents(spark)
    out = near_copies.drop_similar(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    # 1, 2, 9 and the PROSE without an id are one; so are the empty ones and both of "one".
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 7, 8, 8, 10] and ids.count(None) == 1
    assert near_copies.drop_similar(cases.empty(spark)).collect() == []


def test_simhash_proposes_where_no_band_does(spark, monkeypatch):
    """A copy three bits away or less is found by its fingerprint; the exact rule decides."""
    monkeypatch.setattr(near_copies, "bands", lambda hashes: hashes[:0])
    rng = random.Random(7)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    close = [*words[:-1], "other"]
    far = [f"v{i}" for i in range(3000)]
    rows = [(5, " ".join(words)), (3, " ".join(close)), (4, " ".join(far)), (6, ""), (7, None), (8, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in stages.simhash_near_dedup(spark, docs, "").collect()} == {3, 4, 6}


def test_near_fingerprints_of_different_texts_stay(spark, monkeypatch):
    """What SimHash proposes and the exact similarity denies is kept."""
    monkeypatch.setattr(near_copies, "simhash", lambda text: len(text) % 4)
    docs = spark.createDataFrame(
        [(1, "a b c d e f"), (2, "one two three four five six"), (3, None), (4, "u v")], "doc_id long, text string"
    )
    assert {r.doc_id for r in near_copies.drop_similar(docs).collect()} == {1, 2, 3, 4}
