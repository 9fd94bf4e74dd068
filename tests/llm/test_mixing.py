from collections import Counter

import cases
import pytest

from ledgerstrata.llm import mixing


def brute_rake(cells, goals, sweeps=3000):
    """Plain iterative proportional fitting of ``{(source, lang, topic): tokens}``."""
    total = sum(cells.values())
    raked = {k: float(v) for k, v in cells.items() if v}
    for _ in range(sweeps):
        for d in range(3):
            have = Counter()
            for k, v in raked.items():
                have[k[d]] += v
            share = sum(goals[d].get(k, 0) for k in have)
            for k in raked:
                raked[k] *= goals[d].get(k[d], 0) / share * total / have[k[d]] if have[k[d]] else 0
    return raked


def frame(spark, shares):
    return spark.createDataFrame(list(shares.items()), "value string, share double")


def test_raking_meets_every_marginal(spark):
    cells = {
        (s, l, t): 10 + 7 * i + 3 * j * k
        for i, s in enumerate("abcde") for j, l in enumerate(["en", "de"]) for k, t in enumerate("xyz")
    }
    del cells["a", "de", "z"]
    cells["e", "en", "y"] = 0
    goals = (
        {"a": 0.4, "b": 0.3, "c": 0.2, "d": 0.1, "unseen": 5.0}, {"en": 0.5, "de": 0.5},
        {"x": 0.2, "y": 0.3, "z": 0.5},
    )
    table = spark.createDataFrame([(*k, v) for k, v in cells.items()], "source string, lang string, topic string, tokens long")
    targets = {d: frame(spark, g) for d, g in zip(mixing.DIMENSIONS, goals)}
    got = {(r.source, r.lang, r.topic): r.raked for r in mixing.rake(table, targets).collect()}
    want = brute_rake(cells, goals)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-3, abs=1e-6) for k in want)
    # A source without a target gets nothing; a target without tokens is left out.
    assert sum(v for k, v in got.items() if k[0] == "e") == 0
    assert sum(v for k, v in got.items() if k[0] == "a") == pytest.approx(0.4 * sum(cells.values()), rel=1e-4)


def test_slow_and_contradicting_marginals(spark):
    """Nearly empty cells take many sweeps; contradicting targets end with their deviation."""
    schema = "source string, lang string, topic string, tokens long"
    goals = {"source": {"a": 0.7, "b": 0.3}, "lang": {"en": 0.4, "de": 0.6}, "topic": {"x": 1.0}}
    targets = {d: frame(spark, shares) for d, shares in goals.items()}
    rows = [("a", "en", "x", 10**6), ("a", "de", "x", 1), ("b", "en", "x", 1), ("b", "de", "x", 10**6)]
    raked = mixing.stored(mixing.rake(spark.createDataFrame(rows, schema), targets), "test-raked")
    held = {(r.dimension, r.value): (r.goal, r.share) for r in mixing.marginals(raked, targets).collect()}
    assert len(held) == 5
    assert all(goal == pytest.approx(share, abs=1e-4) for goal, share in held.values())
    # Source a has only English: 70 % of a and 40 % of English cannot both hold.
    clash = spark.createDataFrame([("a", "en", "x", 50), ("b", "en", "x", 25), ("b", "de", "x", 25)], schema)
    weights = mixing.cell_weights(clash, targets, 0.5).collect()
    assert len(weights) == 3 and all(r.deviation > 0.1 for r in weights)


def test_rate_meets_the_budget(spark):
    rows = [(100, 300.0), (50, 25.0), (10, 0.0), (40, 75.0)]
    cells = spark.createDataFrame(rows, "tokens long, raked double")
    for budget in (0.0, 10.0, 120.0, 150.0, 185.0, 190.0, 500.0):
        rate = mixing.sampling_rate(cells, budget)
        spent = sum(min(t, rate * r) for t, r in rows)
        assert spent == pytest.approx(min(budget, 190.0), rel=1e-6, abs=1e-6)


def test_topics():
    assert mixing.topic_and_tokens(b"") == (None, 0)
    assert mixing.topic_and_tokens(b"a bc def") == (None, 3)
    topic, tokens = mixing.topic_and_tokens(b"elephant Elephant giraffes")
    assert tokens == 3 and topic == mixing.topic_and_tokens(b"elephant")[0]


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.deviation < 1e-4 for r in rows)
    total = sum(r.tokens for r in rows)
    expected = sum(r.probability * r.tokens for r in rows)
    assert expected == pytest.approx(0.5 * total, rel=1e-6)
    assert sum(r.tokens for r in rows if r.sampled) == pytest.approx(expected, rel=0.03)
    tokens, lang = Counter(), Counter()
    for r in rows:
        lang[r.lang] += r.weight * r.tokens
        tokens[r.lang] += r.tokens
    goal = {k: v**0.7 for k, v in tokens.items()}
    for k in goal:
        assert lang[k] / total == pytest.approx(goal[k] / sum(goal.values()), rel=1e-3)


def test_awkward_rows(spark):
    docs = cases.documents(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(cases.ROWS)
    assert all(0 <= r.probability <= 1 and r.weight >= 0 for r in rows)
    assert {r.lang for r in rows} == {"en", "de", "fr", None}
    # Rows that repeat an id and a cell are drawn together.
    assert len({r.sampled for r in rows if r.doc_id == 7}) == 1
    assert mixing.mix(cases.empty(spark)).collect() == []
    out = mixing.sample_mix(docs, budget_share=1.0)
    assert out.schema.names == docs.schema.names and out.count() == len(cases.ROWS)
    given = mixing.mix(docs, topic_col="source")
    assert all(r.topic == r.source for r in given.collect())
    assert mixing.sample_mix(cases.empty(spark)).collect() == []
