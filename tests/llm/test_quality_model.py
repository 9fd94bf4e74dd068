import cases
import numpy as np
from pyspark.sql import functions as F

from ledgerstrata.llm import quality_model as model


def test_context_sums_match_a_plain_count(spark):
    texts = ["The cat sat, the CAT sat!", "", "sat", "ab12 cd " * 30]
    docs = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string").repartition(3)
    got = {r.bucket: r for r in model.context_sums(docs).collect()}
    plus, minus = model.index_places()
    want, n = {}, {}
    for text in texts:
        ids = model.bucket_ids(text.encode(), model.Buckets()).tolist()
        for i, here in enumerate(ids):
            row = want.setdefault(here, np.zeros(model.DIMENSIONS, int))
            n[here] = n.get(here, 0) + 1
            for j in range(max(0, i - model.WINDOW), min(len(ids), i + model.WINDOW + 1)):
                if j != i:
                    row[plus[ids[j]]] += 1
                    row[minus[ids[j]]] -= 1
    assert got.keys() == want.keys()
    for bucket, row in want.items():
        assert got[bucket].n == n[bucket]
        assert [got[bucket][f"d{i}"] for i in range(model.DIMENSIONS)] == row.tolist()


def test_pooling_does_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(model.WORDS, model.DIMENSIONS)).astype(np.float32)
    weights = rng.random(model.WORDS).astype(np.float32)
    ids = rng.integers(0, model.WORDS, 1000)
    whole = model.pooled(ids, vectors, weights)
    monkeypatch.setattr(model, "PIECE", 64)
    assert np.allclose(model.pooled(ids, vectors, weights), whole, atol=1e-4)
    rows = vectors[ids]
    near = (rows[1:] * rows[:-1]).sum() / len(ids)
    assert abs(whole[2 * model.DIMENSIONS + 1] - near) < 1e-3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = {r.doc_id: r for r in model.score_quality(docs, labels).collect()}
    assert len(got) == docs.count()
    held = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    y = np.array([q for q, _ in held])
    score = np.array([r.score for _, r in held])
    assert ((score >= 0) & (score <= 1)).all()
    assert np.mean([r.predicted == q for q, r in held]) > 0.96
    better = (score[y == 1][:, None] > score[y == 0][None, :]).mean()
    assert better > 0.99
    # Calibrated: the mean probability is near the share of label 1.
    assert abs(score.mean() - y.mean()) < 0.03


def test_awkward_rows_and_labels(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 1), (6, 0), (7, None), (9, 1), (None, 1), (99, 0)], "doc_id long, quality int"
    )
    rows = model.score_quality(docs, labels).collect()
    assert len(rows) == len(cases.ROWS)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    none = model.score_quality(docs, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    only = model.score_quality(docs, labels.where("doc_id = 2")).collect()
    assert {r.score for r in only} == {1.0}
    assert model.score_quality(cases.empty(spark), labels).collect() == []


def test_scores_use_the_text_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    shared, network = model.fit_quality(docs, labels)
    moved = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy"), "doc_id": F.col("doc_id") + 10**6})
    plain = {r.text: r.p for r in model.with_score(docs, shared, network, "text", "p").collect()}
    other = {r.text: r.p for r in model.with_score(moved, shared, network, "text", "p").collect()}
    assert plain == other


def test_keeping_returns_whole_rows(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(2, 1)], "doc_id long, quality int")
    kept = model.keep_quality(docs, labels)
    assert kept.schema == docs.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_training_gives_the_drivers_memory_back(spark, monkeypatch):
    given = []
    monkeypatch.setattr(model, "give_back", lambda: given.append(1))
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(4)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality int")
    model.fit_quality(docs, labels)
    assert given
