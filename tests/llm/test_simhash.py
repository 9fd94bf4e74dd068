import random

import cases
import numpy as np
import xxhash

from ledgerstrata.llm import simhash
from ledgerstrata.llm.components import connected_components


def brute_print(text):
    words = cases.words(text and text.encode().lower().decode())
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    if not shingles and words:
        shingles = [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if linked(a, b) and label[a] != label[b]:
                    low = min(label[a], label[b])
                    label = {n: low if x in (label[a], label[b]) else x for n, x in label.items()}
                    changed = True
    return label


def test_fingerprints(spark, monkeypatch):
    got = {(r.doc_id, r.text_key): r.fp for r in simhash.fingerprints(cases.documents(spark)).collect()}
    want = sorted({(d, brute_print(t)) for d, t, *_ in cases.ROWS}, key=cases.key)
    assert sorted({(d, fp % (1 << 64)) for (d, _), fp in got.items()}, key=cases.key) == want


def test_long_texts_in_blocks():
    from ledgerstrata.llm import common

    text = cases.LONG[:60_000].encode()
    whole = simhash.simhash(text)
    blocks = list(common.word_blocks(text, 1000))
    assert len(blocks) > 20 and sum(blocks, []) == text.split()
    assert whole == brute_print(text.decode())


def close_prints(count, seed):
    """Fingerprints in balls of near ones and chains, and some alone."""
    rng = random.Random(seed)
    out = set()
    while len(out) < count:
        centre = rng.getrandbits(64)
        out.add(centre)
        for _ in range(rng.randrange(12)):
            if rng.random() < 0.3:
                centre = max(out)
            near = centre
            for bit in rng.sample(range(64), rng.randrange(1, 7)):
                near ^= 1 << bit
            out.add(near)
    return sorted(out)


def test_links_in_trees_match_all_pairs(spark):
    prints = close_prints(400, 5)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(5)
    want = brute_components(prints, lambda a, b: a != b and (a ^ b).bit_count() <= 3)
    for rows_per_tree in (1 << 14, 3):
        links = simhash.fingerprint_links(nodes, tree_rows=rows_per_tree)
        assert all((r.u ^ r.v) % (1 << 64) for r in links.collect())
        roots = {r.node: r.root for r in connected_components(links).collect()}
        groups = {}
        for p, s in zip(prints, signed):
            groups.setdefault(roots.get(s, s), set()).add(want[p])
        assert all(len(g) == 1 for g in groups.values())
        assert len(groups) == len(set(want.values()))


def test_large_dense_shard_is_connected():
    rng = np.random.default_rng(1)
    centre = np.uint64(0x0123456789ABCDEF)
    flips = np.zeros(3000, np.uint64)
    for _ in range(4):
        flips ^= np.uint64(1) << rng.integers(0, 38, 3000).astype(np.uint64)
    prints = np.unique(centre ^ flips)
    units = np.zeros(len(prints), np.int64)
    everyone = np.ones(len(prints), bool)
    u, v = simhash.shard_links(units, prints, everyone, everyone, 3)
    label = {int(p): int(p) for p in prints}
    for a, b in zip(u.tolist(), v.tolist()):
        label[a] = b
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    a, b = np.nonzero(near)
    assert all(label[int(prints[x])] == label[int(prints[y])] for x, y in zip(a, b))


def test_awkward_rows(spark):
    rows = simhash.near_duplicates(cases.documents(spark)).collect()
    assert len(rows) == len(cases.ROWS)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert by_id[3] == by_id[4] == by_id[5] == {("0" * 16, 3)}
    assert {c for _, c in by_id[2] | by_id[1]} == {1} and (next(iter(by_id[1]))) in by_id[None]
    assert {c for f, c in by_id[11]} == {8}
    assert simhash.near_duplicates(cases.empty(spark)).collect() == []


def test_dropping_keeps_one_row_of_each_component(spark):
    docs = cases.documents(spark)
    out = simhash.drop_near_copies(docs)
    assert out.columns == docs.columns
    groups = simhash.near_duplicates(docs).collect()
    rows = out.collect()
    with_id = {r.component_id for r in groups if r.component_id is not None}
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(with_id)
    assert [r.text for r in rows if r.doc_id is None] == ["no id at all"]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 200)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []
