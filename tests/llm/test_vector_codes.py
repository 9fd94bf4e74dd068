import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstrata.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({name: F.lit("given") for name in ("vector", "code", "error", "same", "trees", "n")})


def brute(rows, parts=16, entries=64, rounds=2):
    """The contract in plain Python."""
    nan = (None, float("nan"), float("inf"), float("-inf"))
    kept = [r for r in rows if r[1] and not any(x in nan or x != x for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = [
        [[math.floor(256 * x) for x in np.float32(r[1]).astype(float)[i * width : (i + 1) * width]] for i in range(parts)]
        for r in kept
    ]
    books = [[list(c[i]) for c in cut[:entries]] for i in range(parts)]

    def nearest(i, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), at) for at, e in enumerate(books[i]))

    for _ in range(rounds):
        owner = [[nearest(i, c[i])[1] for i in range(parts)] for c in cut]
        for i in range(parts):
            for at in range(len(books[i])):
                mine = [c[i] for c, o in zip(cut, owner) if o[i] == at]
                if mine:
                    books[i][at] = [sum(column) // len(mine) for column in zip(*mine)]
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    sha = hashlib.sha256(flat.encode()).hexdigest()
    found = [[nearest(i, c[i]) for i in range(parts)] for c in cut]
    error = [sum(d for d, _ in f) for f in found]
    labels = {}
    for r, e in zip(kept, error):
        labels[r[2]] = labels.get(r[2], 0) + e
    return [
        (r[0], "".join(f"{at:02x}" for _, at in f), e, labels[r[2]], sha) for r, f, e in zip(kept, found, error)
    ]


def key(row):
    return (row[0] is None, row[0] or 0, row[1:])


def rows_of(n, width, spread, seed):
    rng = random.Random(seed)
    base = [[rng.randrange(-spread, spread + 1) / 256 for _ in range(width)] for _ in range(max(1, n // 3))]
    return [(rng.randrange(n), list(rng.choice(base)), rng.choice((None, 0, 1, 2))) for _ in range(n)]


AWKWARD = [
    (1, None, 1),
    (2, [], 1),
    (3, [0.5, None] * 16, 1),
    (4, [float("nan")] * 32, None),
    (5, [float("inf")] * 32, None),
    (6, [-float("inf")] * 32, None),
    (None, [0.25] * 32, None),
    (7, [0.1] * 48, 3),
    (-8, [-0.001] * 32, None),
    (-8, [-0.001] * 32, None),
    (-8, [0.9] * 32, 2),
    (2**60, [-0.9] * 32, 2),
]


@pytest.mark.parametrize("n,width,spread", [(300, 64, 150), (200, 32, 2), (40, 16, 3000)])
def test_equals_brute_force(spark, n, width, spread):
    rows = rows_of(n, width, spread, n)
    got = vc.vector_codes(frame(spark, rows).repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(rows), key=key)


def test_awkward_rows(spark):
    got = vc.vector_codes(frame(spark, AWKWARD).repartition(2))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want = brute(AWKWARD)
    assert len(want) == 5
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    assert vc.vector_codes(frame(spark, [])).collect() == []
    assert vc.vector_codes(frame(spark, AWKWARD[:6])).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        vc.vector_codes(frame(spark, [(1, [0.5] * 17, 0)]))


def test_many_blocks_and_tasks_give_one_result(spark, monkeypatch):
    rows = rows_of(500, 32, 40, 9)
    monkeypatch.setattr(vc, "BLOCK_ROWS", 70)
    got = vc.vector_codes(frame(spark, rows).repartition(5))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(rows), key=key)


def test_trees_own_whole_balls():
    rng = np.random.default_rng(5)
    centers = rng.integers(-2000, 2000, (64, 4))
    points = (centers[rng.integers(0, 64, 2048)] + rng.integers(-20, 21, (2048, 4))).astype(np.int64)
    tree = vc.Tree.unpack(vc.Tree(points).pack())
    assert sorted(tree.order.tolist()) == list(range(2048))
    for low, high, pivot, reach, total in zip(tree.low, tree.high, tree.pivot, tree.reach, tree.total):
        inside = points[tree.order[low:high]]
        assert (inside.sum(0) == total).all() and ((inside - pivot) ** 2).sum(1).max() == reach
    asked = []
    owner = tree.assign(centers.astype(np.int64), lambda entry, total, count: asked.append(count))
    want = ((points[:, None] - centers[None]) ** 2).sum(2).argmin(1)
    assert (owner == want[tree.order]).all()
    counts = np.concatenate(asked)
    # Nearly all points are counted through the cached sums of a ball, not one by one.
    assert counts.sum() == 2048 and counts[counts > 1].sum() > 1800


def test_equal_entries_go_to_the_first():
    points = np.array([[0], [1], [1], [5], [3]] * 30, np.int64)
    entries = np.array([[9], [1], [1], [5], [5]], np.int64)
    tree = vc.Tree(points)
    owner = np.empty(len(points), np.int64)
    owner[tree.order] = tree.assign(entries)
    assert owner[:5].tolist() == [1, 1, 1, 3, 1]  # 3 is as far from 1 as from 5
