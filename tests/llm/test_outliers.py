import re
from collections import Counter

import cases
import numpy as np

from ledgerstrata.llm import outliers
from ledgerstrata.llm.common import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    found = WORD.findall(text)
    windows = list(zip(found, found[1:], found[2:]))
    often = Counter(windows)
    covered = {at + k for at, window in enumerate(windows) if often[window] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(found)
    return (
        n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
        len(covered), n < 50 or 100 * len(covered) > 50 * n,
    )


def found_counts(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_counts_of_awkward_rows(spark):
    repeats = "a b c a b c a b\nx y\nx y\n\n \nx y z < > & 🎉"
    rows = cases.ROWS + [(20, repeats, "en", "a"), (21, "a a a a", "en", "a"), (22, "a b c d", "en", "a")]
    got = outliers.quality_rules(cases.documents(spark, rows)).collect()
    want = sorted(((d, *brute_counts(t)) for d, t, *_ in rows), key=cases.key)
    assert sorted(((r.doc_id, *found_counts(r)) for r in got), key=cases.key) == want
    # Too few documents for any estimate: the base rule decides alone.
    assert all(r.kept == (not r.base_failed) and r.distance is None for r in got)
    assert outliers.quality_rules(cases.empty(spark)).collect() == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in outliers.quality_rules(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    assert all(found_counts(got[i]) == brute_counts(t) for i, t in texts.items())
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    judged = [got[r.doc_id] for r in labels if r.quality == 1 and not got[r.doc_id].base_failed]
    assert sum(r.kept for r in judged) >= 0.99 * len(judged)
    junk = [got[r.doc_id] for r in labels if r.quality == 0]
    assert sum(r.kept for r in junk) < 0.2 * len(junk)


def test_cutoff_rejects_what_the_distances_separate(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = outliers.quality_rules(docs).join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert all(r.kept == (not r.base_failed and (r.distance or 0) <= 16.2662) for r in rows)
    bad = [r.kept for r in rows if r.quality == 0]
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(bad) <= 0.05 * len(bad) and sum(good) >= 0.99 * len(good)


def test_the_scatter_decides_verdicts(spark):
    """Medians and absolute deviations in place of the estimates give other verdicts."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    statistics = stored(outliers.document_statistics(docs), "test-statistics")
    named = stored(statistics.join(outliers._units(statistics), ["lang", "source"]), "test-named")
    rows = stored(outliers.scaled_vectors(named.where("unit IS NOT NULL AND NOT base_failed")), "test-vectors")
    names = [f"x{i}" for i in range(outliers.P)]
    robust = outliers.robust_estimates(rows.select("unit", *names))
    judged = outliers._with_distance(rows, robust).toPandas()
    x = judged[names].to_numpy() / outliers.UNIT
    plain = np.empty(len(x))
    for unit in judged.unit.unique():
        mine = (judged.unit == unit).to_numpy()
        middle = np.median(x[mine], 0)
        apart = np.median(np.abs(x[mine] - middle), 0) * 1.4826
        plain[mine] = (((x[mine] - middle) / apart) ** 2).sum(1)
    cutoff = outliers.chi2_quantile(outliers.QUANTILE, outliers.P)
    rejected, other = (judged.d2 > cutoff).to_numpy(), plain > cutoff
    assert (rejected != other).sum() >= 0.03 * rejected.sum()
    # No floor takes part: every spread is above it.
    floors = outliers._floors(outliers._spreads(rows), None)
    low = [f"sqrt({'+'.join(f'l{i}_{k}*l{i}_{k}' for k in range(i + 1))}) <= f{i}" for i in range(outliers.P)]
    assert robust.join(floors, "unit").where(" OR ".join(low)).isEmpty()


# --- the estimator against a plain version in numpy ------------------------------------------


def brute_estimate(x):
    """The same starts and concentration steps on one group; ``x`` in 1/1024 units."""
    y = x / outliers.UNIT
    n, p = y.shape

    def consistent(rows, share):
        reach = outliers.chi2_quantile(share, p)
        scatter = np.cov(rows.T, bias=True) * share / outliers._chi2_below(reach, p + 2)
        return rows.mean(0), floored(scatter)

    def floored(scatter):
        out = scatter.copy()
        np.fill_diagonal(out, np.maximum(np.diag(out), floors**2))
        return out

    def distances(mean, scatter):
        away = y - mean
        return np.einsum("ij,jk,ik->i", away, np.linalg.inv(scatter), away)

    middle = np.sort(x, 0)[(n - 1) // 2] / outliers.UNIT
    apart = np.sort(np.abs(y - middle), 0)[(n - 1) // 2] * 1.4826
    floors = np.maximum(outliers.FLOOR_SHARE * apart, 1 / outliers.UNIT)
    apart = np.maximum(apart, floors)
    scores = np.rint(np.tanh((y - middle) / apart) * outliers.UNIT)
    starts = (
        (middle, np.diag(apart**2)),
        (middle, np.corrcoef(scores.T) * np.outer(apart, apart)),
        (y.mean(0), floored(np.cov(y.T, bias=True))),
    )
    found = []
    for estimate in starts:
        before = np.inf
        while True:
            classes = np.floor(np.log2(distances(*estimate) + 1e-9) * outliers.CLASSES)
            reach = np.sort(classes)[int(np.ceil(n * outliers.COVERAGE)) - 1]
            estimate = consistent(y[classes <= reach], outliers.COVERAGE)
            size = np.linalg.slogdet(estimate[1])[1] / 2
            if not size < before - outliers.PROGRESS:
                break
            before = size
            found.append((size, estimate))
    best = min(found, key=lambda pair: pair[0])[1]
    return consistent(y[distances(*best) <= outliers.chi2_quantile(outliers.INSIDE, p)], outliers.INSIDE)


def test_estimates_match_numpy(spark):
    rng = np.random.default_rng(9)
    rows, groups = [], {}
    for unit, n, bad in (("one", 400, 60), ("two", 150, 0), ("three", 90, 20)):
        mix = rng.normal(size=(outliers.P, outliers.P)) * 0.4
        x = rng.normal(size=(n, outliers.P)) @ mix + rng.normal(size=outliers.P)
        x[:bad] += 6
        groups[unit] = np.rint(x * outliers.UNIT).astype(int)
        rows += [(unit, *map(int, r)) for r in groups[unit]]
    names = ", ".join(f"x{i} long" for i in range(outliers.P))
    vectors = spark.createDataFrame(rows, f"unit string, {names}").repartition(6)
    for r in outliers.robust_estimates(vectors).collect():
        mean, scatter = brute_estimate(groups[r.unit])
        lower = np.zeros((outliers.P, outliers.P))
        for i, j in outliers.PAIRS:
            lower[i, j] = r[f"l{i}_{j}"]
        assert np.allclose([r[f"m{i}"] for i in range(outliers.P)], mean, atol=1e-6)
        assert np.allclose(lower @ lower.T, scatter, atol=1e-6)
        if r.unit == "one":  # planted outliers do not move the estimate
            assert np.allclose(mean, groups["one"][60:].mean(0) / outliers.UNIT, atol=0.3)


def test_outliers_go_and_clean_rows_stay(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"{''.join(rng.choice(list('abcdefghijklmnop'), rng.integers(2, 11)))}" for _ in range(4000)]
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(vocabulary, int(rng.integers(80, 900))))
        if i % 30 == 0:
            text = " ".join(word + "###$$$" for word in text.split())
        rows.append((i, text, "en", "web" if i % 3 else "books"))
    rows += [(1000 + i, rows[i][1], None, None) for i in range(100, 130)]
    got = {r.doc_id: r for r in outliers.quality_rules(cases.documents(spark, rows)).collect()}
    assert {i for i in range(300) if not got[i].kept} == set(range(0, 300, 30))


def test_chi_square():
    # Tabled values.
    for p, k, value in ((0.5, 5, 4.3515), (0.95, 5, 11.0705), (0.99, 3, 11.3449), (0.9999, 5, 25.7448), (0.999, 3, 16.2662)):
        assert abs(outliers.chi2_quantile(p, k) - value) < 1e-3
