"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Base rules give counts per text. Three shares that vary in every ordinary text (the
logarithm of the mean word length, punctuation among the characters and short words
among the words, both as arc sines) become a vector: the distance from the median of
the group, times the square root of the number of words, because the chance spread of
a share falls with the length of the text. Documents far from the bulk of their
language and source are rejected by Mahalanobis distance.

Location and scatter are minimum-covariance-determinant estimates: from three
deterministic starts (medians with absolute deviations, those with the correlations
of bounded scores, and plain moments) concentration steps re-estimate from the share
``COVERAGE`` of nearest documents until the determinant falls no more; the least one
wins and is reweighted with all documents inside its ``INSIDE`` quantile.

How it scales: texts are read once, into a stored table of a few numbers per
document. A concentration step is one pass over that table: rows are summed per
group and distance class (64 classes per octave), and a running sum over the
classes gives the nearest share without ranking any row. Sums have map-side
combine, so a group with a third of all rows is a few hundred rows per task. A
start that has converged takes no part in later passes. Statistics are whole numbers
(1/1024 units, at most 2^20 of them), so sums are exact in any order and a repeated
task gives the same estimate.

A spread below ``FLOOR_SHARE`` of the mean robust spread of the language's groups is
raised to it, and to one unit where a statistic is constant in a whole language. A
document is rejected beyond the ``QUANTILE`` of the chi-square distribution.

* NULL and empty texts have no words and fail the base rule.
* NULL language or source is a value of its own.
* Groups of fewer than ``LEAST_ROWS`` base-passing documents are pooled per
  language, pools that are still smaller all together; if that is too few as
  well, the base rule alone decides.
* Repeated rows count as often as they come. No rows give no rows.
* A repeated three-word window is recognised by a 64-bit hash of its words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstrata.llm.common import SPACES, stored

SYMBOLS = r"[^#*$%&|<>]+"
# Characters that are no punctuation.
PLAIN = r"[\p{L}\p{M}\p{N}\s]+"
SHORT_WORD = 3
STATISTICS = ("word_length", "punctuation", "short_words")
SHARE_UNIT = 1 << 16
UNIT = 1024
LARGEST = 1 << 20
CLASSES = 64
COVERAGE = 0.75
INSIDE = 0.975
FLOOR_SHARE = 0.25
# One clean document in a thousand lies beyond, if the vectors are normal.
QUANTILE = 0.999
LEAST_ROWS = 60
# A fall of the determinant's logarithm that counts as progress.
PROGRESS = 1e-6
ABSENT = "\u0000"
POOL = "\u0001"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


# --- base rules ---------------------------------------------------------------------------


def _covered(starts: Column) -> Column:
    """Words covered by three-word windows that start at the sorted places."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda so_far, at: F.struct(
            (so_far["n"] + F.least(F.lit(3), at - so_far["last"])).alias("n"), at.alias("last")
        ),
        lambda so_far: so_far["n"],
    )


def _repeat_words(words: Column) -> Column:
    def shared(rows: Column) -> Column:
        same = lambda a, b: a["h"].eqNullSafe(b["h"])
        twice = F.filter(
            rows,
            lambda row, i: ((i > 0) & same(row, F.get(rows, i - 1))) | same(row, F.get(rows, i + 1)),
        )
        return _covered(F.array_sort(F.transform(twice, lambda row: row["at"])))

    def counted(hashes: Column) -> Column:
        rows = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        # Most texts repeat nothing and need no sort.
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            _let(F.sort_array(rows), shared)
        )

    places = F.sequence(F.lit(0), F.size(words) - 3)
    windows = F.transform(
        places, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )
    return F.when(F.size(words) < 3, 0).otherwise(_let(windows, counted))


def text_counts(text: Column) -> Column:
    """Struct of the base counts (long), and of short words and punctuation characters."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda word: word != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    from_words = _let(
        words,
        lambda found: F.struct(
            F.size(found).cast("long").alias("n_words"),
            F.aggregate(found, F.lit(0).cast("long"), lambda n, word: n + F.char_length(word)).alias("word_chars"),
            _repeat_words(found).cast("long").alias("n_repeat_words"),
            F.size(F.filter(found, lambda word: F.char_length(word) <= SHORT_WORD)).alias("n_short"),
        ),
    )
    dup_lines = _let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))
    return F.struct(
        from_words.alias("w"),
        F.char_length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
        dup_lines.cast("long").alias("n_dup_lines"),
        F.char_length(F.regexp_replace(text, PLAIN, "")).alias("n_punctuation"),
    )


def document_statistics(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Counts, base verdict and the shares ``r*`` of every document."""
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit(ABSENT)).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit(ABSENT)).alias("source"),
        text_counts(F.col(text_col)).alias("c"),
    ).select("doc_id", "lang", "source", "c.w.*", "c.n_symbols", "c.n_dup_lines", "c.n_punctuation")
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    share = lambda part, of: F.asin(F.sqrt(F.least(part / of, F.lit(1.0))))
    shares = {
        "word_length": F.log(chars / words),
        "punctuation": share(F.col("n_punctuation"), chars),
        "short_words": share(F.col("n_short"), words),
    }
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", failed.alias("base_failed"),
        *[F.round(shares[name] * SHARE_UNIT).cast("long").alias(f"r{i}") for i, name in enumerate(STATISTICS)],
    )


# --- chi-square, for the consistency factor and the cutoff -----------------------------------


def _chi2_below(x: float, k: int) -> float:
    """P(chi-square with ``k`` degrees of freedom <= x), by the series of the incomplete gamma."""
    a, half = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > 1e-16 * total:
        n += 1
        term *= half / (a + n)
        total += term
    return total * math.exp(a * math.log(half) - half - math.lgamma(a))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 1e-9, 10.0 * k + 100
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_below(mid, k) < p else (low, mid)
    return (low + high) / 2


# --- minimum covariance determinant -----------------------------------------------------------

P = len(STATISTICS)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
SUMS = ["n", *(f"s{i}" for i in range(P)), *(f"s{i}_{j}" for i, j in PAIRS)]


def _sums() -> list[Column]:
    return [
        F.count("*").alias("n"),
        *[F.sum(f"x{i}").alias(f"s{i}") for i in range(P)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in PAIRS],
    ]


def _middle(counts: DataFrame, value: str) -> DataFrame:
    """The lower median per unit and statistic of values that are counted in ``n``."""
    order = Window.partitionBy("unit", "which").orderBy(value)
    whole = Window.partitionBy("unit", "which")
    return (
        counts.withColumn("upto", F.sum("n").over(order))
        .withColumn("all", F.sum("n").over(whole))
        .where(2 * F.col("upto") >= F.col("all"))
        .groupBy("unit", "which")
        .agg(F.min(value).alias("middle"))
    )


def _counted(rows: DataFrame, letter: str) -> DataFrame:
    names = [f"{letter}{i}" for i in range(P)]
    return (
        rows.select("unit", *names)
        .unpivot("unit", names, "which", "value")
        .groupBy("unit", F.substring("which", 2, 9).cast("int").alias("which"), "value")
        .agg(F.count("*").alias("n"))
    )


def _wide(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row per unit from rows per unit and statistic; ``columns`` maps names to letters."""
    return rows.groupBy("unit").agg(
        *[
            F.max(F.when(F.col("which") == i, F.col(name))).alias(f"{letter}{i}")
            for name, letter in columns.items()
            for i in range(P)
        ]
    )


def scaled_vectors(rows: DataFrame) -> DataFrame:
    """``rows`` (unit, n_words, base_failed, r*) with the vector ``x*`` instead of the shares."""
    passed = rows.where("NOT base_failed")
    centres = stored(_wide(_middle(_counted(passed, "r"), "value"), {"middle": "c"}), "centres")
    length = F.sqrt(F.col("n_words").cast("double")) * (UNIT / SHARE_UNIT)
    vector = [
        F.least(F.greatest(F.round((F.col(f"r{i}") - F.col(f"c{i}")) * length), F.lit(-LARGEST)), F.lit(LARGEST))
        .cast("long").alias(f"x{i}")
        for i in range(P)
    ]
    kept = [c for c in rows.columns if c not in {f"r{i}" for i in range(P)}]
    return rows.join(centres, "unit").select(*kept, *vector)


def _factored(moments: DataFrame, floors: DataFrame, scale: float) -> DataFrame:
    """Means ``m*`` and the Cholesky factor ``l*_*`` of the floored scatter, plus ``logdet``."""
    keys = [c for c in moments.columns if c not in SUMS]
    out = moments.join(floors, "unit").select(
        *keys,
        *[(F.col(f"s{i}") / F.col("n") / UNIT).alias(f"m{i}") for i in range(P)],
        *[
            F.greatest(variance, F.col(f"f{i}") * F.col(f"f{i}")).alias(f"v{i}_{j}") if i == j
            else variance.alias(f"v{i}_{j}")
            for (i, j), variance in (
                (
                    (i, j),
                    (F.col(f"s{i}_{j}") / F.col("n") - F.col(f"s{i}") / F.col("n") * (F.col(f"s{j}") / F.col("n")))
                    * F.lit(scale / UNIT / UNIT),
                )
                for i, j in PAIRS
            )
        ],
    )
    return _cholesky(out, keys)


def _cholesky(scatter: DataFrame, keys: list[str]) -> DataFrame:
    out = scatter
    for j in range(P):
        below = sum((F.col(f"l{j}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
        # Statistics that determine one another leave a millionth of the variance.
        rest = F.greatest(F.col(f"v{j}_{j}") - below, F.col(f"v{j}_{j}") * 1e-6)
        out = out.withColumn(f"l{j}_{j}", F.sqrt(rest))
        for i in range(j + 1, P):
            rest = sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l{i}_{j}", (F.col(f"v{i}_{j}") - rest) / F.col(f"l{j}_{j}"))
    logdet = sum((F.log(F.col(f"l{i}_{i}")) for i in range(P)), F.lit(0.0))
    return out.select(
        *keys,
        *[f"m{i}" for i in range(P)],
        *[f"l{i}_{j}" for i, j in PAIRS],
        logdet.alias("logdet"),
    )


def _with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Join ``rows`` to their group's estimate and append the squared distance ``d2``."""
    out = rows.join(estimates, "unit")
    kept = rows.columns + [c for c in estimates.columns if c == "start"]
    for i in range(P):
        rest = sum((F.col(f"l{i}_{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"y{i}", (F.col(f"x{i}") / UNIT - F.col(f"m{i}") - rest) / F.col(f"l{i}_{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(P)), F.lit(0.0))
    return out.select(*kept, d2.alias("d2"))


def _units(statistics: DataFrame) -> DataFrame:
    """``(lang, source, unit)`` of the groups that get an estimate, pooled where they are small."""
    sizes = statistics.where("NOT base_failed").groupBy("lang", "source").agg(F.count("*").alias("rows"))
    all_groups = statistics.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left")
    groups = stored(all_groups.select("lang", "source", F.coalesce("rows", F.lit(0)).alias("rows")), "groups")
    small = F.when(F.col("rows") < LEAST_ROWS, F.col("rows")).otherwise(0)
    pools = stored(groups.groupBy("lang").agg(F.sum(small).alias("pool")), "group-pools")
    left_over = F.when(F.col("pool") < LEAST_ROWS, F.col("pool")).otherwise(0)
    rest = pools.agg(F.sum(left_over)).first()[0] or 0
    unit = (
        F.when(F.col("rows") >= LEAST_ROWS, F.concat_ws(POOL, "lang", "source"))
        .when(F.col("pool") >= LEAST_ROWS, F.concat("lang", F.lit(POOL + POOL)))
        .when(F.lit(rest >= LEAST_ROWS), F.lit(POOL + POOL + POOL))
    )
    return groups.join(pools, "lang").select("lang", "source", unit.alias("unit"))


def _spreads(vectors: DataFrame) -> DataFrame:
    """Medians ``c*`` and scaled absolute deviations ``d*`` per unit, from counts of the values."""
    values = stored(_counted(vectors, "x"), "value-counts")
    medians = stored(_middle(values, "value"), "medians")
    apart = (
        values.join(medians, ["unit", "which"])
        .select("unit", "which", F.abs(F.col("value") - F.col("middle")).alias("apart"), "n")
        .groupBy("unit", "which", "apart")
        .agg(F.sum("n").alias("n"))
    )
    spreads = _middle(apart, "apart").select("unit", "which", (F.col("middle") * 1.4826).alias("spread"))
    return _wide(medians.join(spreads, ["unit", "which"]), {"middle": "c", "spread": "d"})


def _floors(spreads: DataFrame, families: DataFrame | None) -> DataFrame:
    """The least spread ``f*`` granted per unit: a share of its family's mean spread, or one unit."""
    own = spreads.withColumn("family", F.col("unit"))
    if families is not None:
        own = spreads.join(families, "unit", "left").withColumn("family", F.coalesce("family", "unit"))
    means = own.groupBy("family").agg(*[F.avg(f"d{i}").alias(f"a{i}") for i in range(P)])
    return own.join(means, "family").select(
        "unit", *[(F.greatest(FLOOR_SHARE * F.col(f"a{i}"), F.lit(1.0)) / UNIT).alias(f"f{i}") for i in range(P)]
    )


def _starts(vectors: DataFrame, spreads: DataFrame, floors: DataFrame) -> DataFrame:
    """The three first estimates of every unit."""
    wide = stored(
        spreads.join(floors, "unit").select(
            "unit", *[(F.col(f"c{i}") / UNIT).alias(f"m{i}") for i in range(P)],
            *[F.greatest(F.col(f"d{i}") / UNIT, F.col(f"f{i}")).alias(f"d{i}") for i in range(P)],
        ),
        "robust-spreads",
    )
    # Bounded scores as whole numbers, so that their sums are exact.
    bounded = vectors.join(wide, "unit").select(
        "unit",
        *[
            F.round(F.tanh((F.col(f"x{i}") / UNIT - F.col(f"m{i}")) / F.col(f"d{i}")) * UNIT).cast("long").alias(f"x{i}")
            for i in range(P)
        ],
    )
    sums = bounded.groupBy("unit").agg(*_sums()).join(wide, "unit")

    def moment(i: int, j: int) -> Column:
        return F.col(f"s{i}_{j}") - F.col(f"s{i}") * (F.col(f"s{j}") / F.col("n"))

    def scatter(i: int, j: int) -> Column:
        size = F.sqrt(moment(i, i) * moment(j, j))
        return F.when(size > 0, moment(i, j) / size).otherwise(0.0) * F.col(f"d{i}") * F.col(f"d{j}")

    square = {i: F.col(f"d{i}") * F.col(f"d{i}") for i in range(P)}
    means = [f"m{i}" for i in range(P)]
    medians = wide.select(
        "unit", F.lit(0).alias("start"), *means,
        *[(square[i] if i == j else F.lit(0.0)).alias(f"v{i}_{j}") for i, j in PAIRS],
    )
    scores = sums.select(
        "unit", F.lit(1).alias("start"), *means,
        *[(square[i] if i == j else scatter(i, j)).alias(f"v{i}_{j}") for i, j in PAIRS],
    )
    robust = _cholesky(medians.unionByName(scores), ["unit", "start"])
    plain = _factored(vectors.groupBy("unit").agg(*_sums()), floors, 1.0).withColumn("start", F.lit(2))
    return robust.unionByName(plain)


def robust_estimates(
    vectors: DataFrame, families: DataFrame | None = None, coverage: float = COVERAGE
) -> DataFrame:
    """Reweighted minimum-covariance-determinant mean and Cholesky factor per ``unit``.

    ``vectors`` holds ``unit`` and ``x*``, and should be a stored table; ``families``
    names the ``family`` of a ``unit`` whose mean spread bounds the unit's from below.
    """
    nearest = chi2_quantile(coverage, P)
    scale = coverage / _chi2_below(nearest, P + 2)
    spreads = stored(_spreads(vectors), "spreads")
    floors = stored(_floors(spreads, families), "floors")
    # The determinant of a start comes from other rows than those of the steps.
    active = stored(_starts(vectors, spreads, floors), "mcd-start").withColumn("logdet", F.lit(math.inf))
    keys = Window.partitionBy("unit", "start")
    found = None
    while not active.isEmpty():
        classes = (
            _with_distance(vectors, active)
            .withColumn("class", F.floor(F.log2(F.col("d2") + 1e-9) * CLASSES).cast("int"))
            .groupBy("unit", "start", "class")
            .agg(*_sums())
        )
        nearest_rows = (
            classes.withColumn("upto", F.sum("n").over(keys.orderBy("class")))
            .withColumn("all", F.sum("n").over(keys))
            # The class that reaches the share is taken whole.
            .where(F.col("upto") - F.col("n") < F.ceil(F.col("all") * coverage))
            .groupBy("unit", "start")
            .agg(*[F.sum(name).alias(name) for name in SUMS])
        )
        before = active.select("unit", "start", F.col("logdet").alias("before"))
        # Whole classes may let a step rise, which ends that start like one that stands still.
        better = (
            _factored(nearest_rows, floors, scale)
            .join(before, ["unit", "start"])
            .where(F.col("logdet") < F.col("before") - PROGRESS)
            .drop("before")
        )
        active = stored(better, "mcd-step")
        found = active if found is None else found.unionByName(active)
    if found is None:
        return active.drop("start", "logdet")
    order = Window.partitionBy("unit").orderBy("logdet", "start")
    best = stored(found.withColumn("place", F.row_number().over(order)).where("place = 1"), "mcd")
    reach = chi2_quantile(INSIDE, P)
    inner = _with_distance(vectors, best.drop("place", "start")).where(F.col("d2") <= reach)
    reweighted = _factored(inner.groupBy("unit").agg(*_sums()), floors, INSIDE / _chi2_below(reach, P + 2))
    return stored(reweighted.drop("logdet"), "mcd-reweighted")


def quality_rules(docs: DataFrame, **columns) -> DataFrame:
    """One row per document: the base counts, base_failed, kept, and the squared distance."""
    statistics = stored(document_statistics(docs, **columns), "statistics")
    units = stored(_units(statistics), "units")
    named = stored(statistics.join(units, ["lang", "source"]), "unit-statistics")
    rows = stored(scaled_vectors(named.where("unit IS NOT NULL")), "vectors")
    vectors = rows.where("NOT base_failed").select("unit", *[f"x{i}" for i in range(P)])
    # A pool of several languages is a family of its own.
    families = units.where("unit IS NOT NULL").groupBy("unit").agg(
        F.when(F.count_distinct("lang") == 1, F.min("lang")).alias("family")
    )
    estimates = robust_estimates(vectors, families)
    wanted = [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    ]
    measured = _with_distance(rows, estimates).select(*wanted, F.col("d2").alias("distance"))
    # A group without a base-passing document has no estimate and nothing to judge.
    unmeasured = (
        named.join(estimates.select(F.col("unit").alias("known")), F.col("unit") == F.col("known"), "left_anti")
        .select(*wanted, F.lit(None).cast("double").alias("distance"))
    )
    near = F.col("distance").isNull() | (F.col("distance") <= chi2_quantile(QUANTILE, P))
    return measured.unionByName(unmeasured).select(
        *wanted, (~F.col("base_failed") & near).alias("kept"), F.round("distance", 6).alias("distance")
    )
