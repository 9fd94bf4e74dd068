import random
import zlib

import cases
import numpy as np
import pytest

from ledgerstrata.llm import toxicity as tox

BAD = ("scoundrel", "blockhead", "nitwit", "rascal")


def plain_buckets(word):
    """The buckets of one word, character by character."""
    mask = (1 << 64) - 1
    marks = {chr(c) for c in (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127))}
    body = word.lower()
    core = body.strip("".join(marks)) or body
    framed = f"<{core}>"
    runs = [(framed, 0)] + [(framed[i : i + n], n) for n in tox.GRAMS for i in range(len(framed) - n + 1)]
    out = []
    for run, n in runs:
        h = sum(ord(c) * pow(int(tox._BASE), i, 1 << 64) for i, c in enumerate(run)) + n & mask
        h = h * int(tox._SPREAD) & mask
        h ^= h >> 32
        out.append((h * int(tox._SPREAD) & mask) >> 47)
    return sorted(out)


def test_buckets_of_words():
    text = "Hello,  (WORLD)\t!!! a é語x -- it's <tag>\n" + "long" * 50
    starts, bucket, owner = tox.Subwords()(text.lower())
    words = text.split()
    assert [text[s:].split()[0] for s in starts] == words
    for i, word in enumerate(words):
        assert sorted(bucket[owner == i].tolist()) == plain_buckets(word), word
    assert len(tox.Subwords()(" \n ")[0]) == 0 == len(tox.Subwords()("")[0])
    assert len(tox.Subwords()("x" * (3 * tox.BLOCK))[0]) == 1


def made(n, seed, bad_share=0.3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices("aeioulmnrst", k=rng.randrange(2, 8))) for _ in range(rng.choice((20, 90, 700)))]
        toxic = rng.random() < bad_share
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = rng.choices(BAD, k=3)
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def scored(spark):
    rows, labels = made(1200, 3)
    # Held-out documents carry misspelt words that no training text has.
    swap = {"scoundrel": "scoundrrel", "blockhead": "Blockheadd!!", "nitwit": "nitwitt", "rascal": "***rasscal***"}
    rows = [
        (i, " ".join(swap.get(w, w) for w in text.split()) if zlib.crc32(str(i).encode()) % 4 == 2 else text, a, b)
        for i, text, a, b in rows
    ]
    docs = cases.documents(spark, rows)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in tox.score_toxicity(docs, known).collect()}
    return rows, dict(labels), got, docs, known


def test_held_out_misspellings(scored):
    rows, labels, got, _, _ = scored
    assert len(got) == len(rows)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [i for i in got if got[i].held_out]
    bad = np.array([got[i].score for i in held if labels[i]])
    good = np.array([got[i].score for i in held if not labels[i]])
    assert (bad[:, None] > good[None, :]).mean() > 0.85 and (good >= 0.3).mean() < 0.05


def test_held_out_texts(spark):
    rows, labels = made(1200, 4)
    docs, known = cases.documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    label = dict(labels)
    held = [r for r in tox.score_toxicity(docs, known).collect() if r.held_out]
    assert np.mean([r.predicted for r in held if label[r.doc_id]]) > 0.9
    assert np.mean([r.predicted for r in held if not label[r.doc_id]]) < 0.05


def test_labels_of_the_held_out_fold_are_not_read(spark, scored):
    _, labels, got, docs, known = scored
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    turned = [(i, 1 - y if i in set(held) else y) for i, y in labels.items()]
    again = tox.score_toxicity(docs, spark.createDataFrame(turned, "doc_id long, toxic int"))
    assert {r.doc_id: r.score for r in again.collect()} == {i: r.score for i, r in got.items()}


def test_scores_by_hand(spark, scored):
    _, _, got, docs, known = scored
    model = tox.fit_toxicity(docs, known)
    texts = {r.doc_id: r.text for r in docs.where("doc_id % 40 = 0").collect()}
    for i, text in texts.items():
        words = text.split()
        value = [float(np.mean(model.of_bucket[plain_buckets(w)])) for w in words]
        cuts = list(range(0, max(len(words) - 64, 0) + 1, 64))
        cuts += [len(words) - 64] if cuts[-1] + 64 < len(words) else []
        logit = model.intercept + max(sum(value[c : c + 64]) for c in cuts) / 64
        assert got[i].score == pytest.approx(1 / (1 + np.exp(-logit)), rel=1e-3, abs=1e-9)


def test_awkward_rows(spark):
    docs = cases.documents(spark)
    labels = [(1, 1), (2, None), (4, 0), (10, 0), (11, 1), (11, 0), (None, 1)]
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = tox.score_toxicity(docs, known)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == len(cases.ROWS) and all(0 <= r.score <= 1 for r in rows)
    for some, share in (([(1, 1), (6, 1)], 1.0), ([], 0.5)):
        one = tox.score_toxicity(docs, spark.createDataFrame(some, "doc_id long, toxic int"))
        assert {r.score for r in one.collect()} == {share}
    assert tox.score_toxicity(cases.empty(spark), known).collect() == []
    kept = tox.drop_toxic(docs, known, threshold=2.0)
    assert kept.columns == docs.columns and kept.count() == len(cases.ROWS)


def test_blocks_do_not_change_a_score(monkeypatch):
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdé", k=rng.randrange(1, 9))) for _ in range(3000)).encode()
    model = object.__new__(tox.SubwordSoftmax)
    model.fitted, model.rate, model.intercept = True, 0.5, -1.0
    weights = np.random.default_rng(1).normal(0, 1, tox.BUCKETS).astype(np.float32)
    short = [b"", b"abc abd", b" \n", b"x y z"]
    want = model.score([text, *short], weights, tox.Subwords())
    monkeypatch.setattr(tox, "BLOCK", 100)
    assert np.allclose(model.score([*short, text], weights, tox.Subwords())[[4, 0, 1, 2, 3]], want, rtol=1e-9)
