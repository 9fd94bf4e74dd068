import cases
import test_near_copies as near

import corpus_pipeline
from ledgerstrata.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages_on_the_given_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    columns = rows.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in rows.collect()}
        rows = stored(stage(spark, rows, SF), "test-stage")
        assert rows.columns == columns
        after = {r.doc_id: r for r in rows.collect()}
        assert all(before[i] == r for i, r in after.items())
        if name == "quality_classifier":
            good = [i for i in before if labels.get(i) == 1]
            assert sum(i in after for i in good) >= 0.95 * len(good)
            bad = [i for i in before if labels.get(i) == 0]
            assert sum(i in after for i in bad) <= 0.3 * len(bad)
        if name == "exact_dedup":
            best = {}
            for i, r in before.items():
                body = cases.lower(r.text)
                best[body] = max(i, best.get(body, i))
            assert set(after) == set(best.values())
        if name == "simhash_near_dedup":
            # The stage's own rule: five-word Jaccard of 0.8 or more, by brute force over all pairs.
            assert set(after) == near.expected([(i, r.text) for i, r in before.items()])
        sizes.append(len(after))
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in rows.collect()}


def test_run_and_awkward_rows(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF).count() > 0
    for name, docs in (("awkward", cases.documents(spark)), ("empty", cases.empty(spark))):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1), (10, 0)], "doc_id long, quality int").write.parquet(
            f"{folder}/labels.parquet"
        )
        rows = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, function in corpus_pipeline.STAGES[:-1]:
            rows = stored(function(spark, rows, folder), "test-stage")
            assert rows.columns == docs.columns, stage
        packed = corpus_pipeline.STAGES[-1][1](spark, rows, folder)
        assert (packed.count() == 0) == (name == "empty")
