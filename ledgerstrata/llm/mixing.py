"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The token counts of the
cells are raked in turn to the target shares of each of the three marginals
until all hold or the sweeps make no more progress, which happens where the
marginals contradict each other; ``deviation`` says what is left. A document's weight is its cell's raked tokens over its own
tokens; its sampling probability is the weight times a constant, at most one,
and the constant is chosen so that the expected tokens meet the budget.

Cells are counted with map-side sums, so a source that holds a third of all rows
is a few rows per task. Raking works on a stored table of sources in Spark; only
the sums by language and topic, and those that set the constant, reach the driver.

Where targets are not given, a marginal is flattened: shares in proportion to
observed tokens to a power (``FLATTENING``; 0 is uniform). The tables have no
topic column, so a topic is taken from the whole text: its longer words vote for
one of ``TOPICS`` hash groups. ``topic_col`` names a column to use instead.

* NULL source, language or topic is a category of its own.
* NULL and empty texts have no tokens: weight and probability follow their cell,
  and a cell without tokens has weight one.
* A category without a target row has target zero, so it is never sampled.
* A draw depends on the id alone: rows that repeat an id are sampled together,
  and so are rows with a NULL id.
* No rows give no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstrata.llm.common import map_texts, spare_name, stored, word_blocks

TOPICS = 8
TOPIC_WORD = 7  # bytes of a word that votes
FLATTENING = {"source": 0.7, "lang": 0.7, "topic": 0.5}
DIMENSIONS = ("source", "lang", "topic")
ABSENT = "\u0000"
TOLERANCE = 1e-5
PATIENCE = 50  # sweeps in which the worst factor has to come nearer to one by ...
PROGRESS = 0.95  # ... this much; marginals that contradict each other make none
MOST_PAIRS = 1_000_000


def topic_and_tokens(text: bytes) -> tuple[str | None, int]:
    """The hash group with most votes (the least of equals) and the number of words."""
    votes, tokens = Counter(), 0
    for words in word_blocks(text.lower()):
        tokens += len(words)
        votes.update([zlib.crc32(word) % TOPICS for word in words if len(word) >= TOPIC_WORD])
    if not votes:
        return None, tokens
    return f"t{min(votes, key=lambda topic: (-votes[topic], topic))}", tokens


def with_facts(
    docs: DataFrame,
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic_col: str | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its cell and tokens in columns of their own, and the names of those columns."""
    names = {name: spare_name(docs, f"mix_{name}") for name in (*DIMENSIONS, "tokens")}
    read = map_texts(
        docs, text_col, lambda: topic_and_tokens, {names["topic"]: "string", names["tokens"]: "long"}
    )
    given = {"source": source_col, "lang": lang_col, "topic": topic_col or names["topic"]}
    cell = {
        names[d]: F.coalesce(F.col(column).cast("string"), F.lit(ABSENT)) for d, column in given.items()
    }
    return read.withColumns(cell), names


def flattened(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares ``(value, share)`` in proportion to observed tokens to ``power``."""
    totals = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("t"))
    sizes = totals.where("t > 0").withColumn("s", F.pow(F.col("t").cast("double"), F.lit(power)))
    return sizes.select("value", (F.col("s") / sizes.agg(F.sum("s")).scalar()).alias("share"))


def _goals(cells: DataFrame, dimension: str, target: DataFrame) -> DataFrame:
    """Target shares of the categories that have tokens, made to add up to one."""
    present = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).where("t > 0").drop("t")
    named = target.select(F.col("value").alias(dimension), F.col("share").cast("double"))
    joined = present.join(named, dimension, "left").select(
        dimension, F.coalesce("share", F.lit(0.0)).alias("share")
    )
    whole = joined.agg(F.sum("share")).scalar()
    return joined.select(dimension, F.coalesce(F.try_divide("share", whole), F.lit(0.0)).alias("goal"))


def _lookup(factors: dict[str, float], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in factors.items() for x in pair]), key)


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Append ``raked`` to the cells with tokens: tokens scaled until each marginal has its share.

    The sweeps end when every factor is within ``TOLERANCE`` of one, or when
    ``PATIENCE`` of them have not brought the worst factor ``PROGRESS`` nearer.

    ``cells`` has the three dimensions and ``tokens``. A sweep is one pass over a
    stored table with a row per source: the source's factor follows from those of
    the languages and topics, and the languages' and topics' next factors follow
    from the sums by language and topic. Only those sums reach the driver, so
    languages and topics must be closed lists (``MOST_PAIRS`` combinations);
    sources may be any number.
    """
    filled = cells.where("tokens > 0")
    total = float(filled.agg(F.sum("tokens")).first()[0] or 0)
    goals = {}
    for dimension in ("lang", "topic"):
        rows = _goals(cells, dimension, targets[dimension]).limit(MOST_PAIRS + 1).collect()
        goals[dimension] = {row[0]: row[1] * total for row in rows}
    if len(goals["lang"]) * len(goals["topic"]) > MOST_PAIRS:
        raise ValueError("languages and topics must be closed lists")
    sources = stored(
        filled.groupBy("source")
        .agg(F.collect_list(F.struct("lang", "topic", "tokens")).alias("parts"))
        .join(_goals(cells, "source", targets["source"]), "source")
        .select("source", "parts", (F.col("goal") * total).alias("goal")),
        "mix-sources",
    )
    if not total:
        return filled.withColumn("raked", F.lit(0.0))
    lang = dict.fromkeys(goals["lang"], 1.0)
    topic = dict.fromkeys(goals["topic"], 1.0)

    def spread() -> DataFrame:
        """The cells after the sources' step, with the factors as they are now."""

        def value(part: Column) -> Column:
            return part["tokens"] * _lookup(lang, part["lang"]) * _lookup(topic, part["topic"])

        have = F.aggregate("parts", F.lit(0.0), lambda so_far, part: so_far + value(part))
        scaled = sources.select(
            "source", "parts", F.when(have > 0, F.col("goal") / have).otherwise(0.0).alias("factor")
        )
        opened = scaled.select("source", "factor", F.explode("parts").alias("part"))
        return opened.select(
            "source", "part.lang", "part.topic", "part.tokens",
            (F.col("factor") * value(F.col("part"))).alias("raked"),
        )

    history = []
    while True:
        sums = spread().groupBy("lang", "topic").agg(F.sum("raked").alias("raked")).collect()
        table = {(row["lang"], row["topic"]): row["raked"] for row in sums}
        worst = 0.0
        for at, factors, goal in ((0, lang, goals["lang"]), (1, topic, goals["topic"])):
            have = dict.fromkeys(factors, 0.0)
            for key, raked in table.items():
                have[key[at]] += raked
            step = {k: goal[k] / have[k] if have[k] > 0 else 1.0 for k in factors}
            worst = max([worst, *(abs(x - 1) for k, x in step.items() if goal[k] > 0 and have[k] > 0)])
            for key in table:
                table[key] *= step[key[at]]
            for key, x in step.items():
                factors[key] *= x
        history.append(worst)
        slow = len(history) > PATIENCE and worst > PROGRESS * history[-1 - PATIENCE]
        if worst < TOLERANCE or slow:
            return spread()


def marginals(raked: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Rows ``(dimension, value, goal, share)``: the target and the raked share of each
    category that has tokens. ``raked`` is a stored table."""
    whole = raked.agg(F.sum("raked")).scalar()
    parts = []
    for dimension in DIMENSIONS:
        have = raked.groupBy(dimension).agg(F.sum("raked").alias("have"))
        parts.append(
            have.join(_goals(raked, dimension, targets[dimension]), dimension).select(
                F.lit(dimension).alias("dimension"), F.col(dimension).alias("value"), "goal",
                F.coalesce(F.try_divide("have", whole), F.lit(0.0)).alias("share"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def sampling_rate(cells: DataFrame, budget: float) -> float:
    """The constant ``c`` for which the sum of min(tokens, c * raked) is ``budget``."""
    rate = 0.0
    while True:
        full = (F.col("raked") * rate) >= F.col("tokens")
        spent, free = cells.agg(
            F.sum(F.when(full, F.col("tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("raked")))
        ).first()
        if not free or budget <= spent:
            return rate
        new = (budget - float(spent)) / float(free)
        # Full cells only become more, so the rate only rises until it is right.
        if new <= rate * (1 + 1e-12):
            return new
        rate = new


def _draw(doc_id: Column, seed: int) -> Column:
    """A uniform number in [0, 1) that depends on the id and the seed alone."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11) / F.lit(float(1 << 53))


def cell_weights(
    cells: DataFrame,
    targets: dict[str, DataFrame] | None,
    budget_share: float,
) -> DataFrame:
    """Weight and sampling probability per cell; ``cells`` is a stored table.

    ``deviation`` is the same on every row: the largest absolute difference between
    a category's target and its raked share.
    """
    goals = {d: flattened(cells, d, FLATTENING[d]) for d in DIMENSIONS} | (targets or {})
    raked = stored(rake(cells, goals), "mix-raked")
    off = marginals(raked, goals).agg(F.max(F.abs(F.col("goal") - F.col("share")))).scalar()
    all_tokens = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    rate = sampling_rate(raked, budget_share * all_tokens)
    scaled = raked.select(*DIMENSIONS, (F.col("raked") / F.col("tokens")).alias("weight"))
    weight = F.coalesce("weight", F.lit(1.0))
    return stored(
        cells.join(scaled, list(DIMENSIONS), "left").select(
            *DIMENSIONS,
            F.round(weight, 9).alias("weight"),
            F.round(F.least(F.lit(1.0), weight * rate), 9).alias("probability"),
            F.round(F.coalesce(off, F.lit(0.0)), 9).alias("deviation"),
        ),
        "mix-weights",
    )


def mix(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    budget_share: float = 0.5,
    seed: int = 1,
    id_col: str = "doc_id",
    **columns,
) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, tokens, weight, probability, sampled,
    deviation (of the raked shares from their targets, the largest of all categories).

    ``targets`` maps dimensions to frames ``(value, share)``; the others are
    flattened. ``budget_share`` is the part of all tokens that a sample is
    expected to hold. Where a cell has too few tokens for its target it is taken
    whole, and the others share the rest in proportion.
    """
    read, names = with_facts(docs, **columns)
    facts = stored(
        read.select(F.col(id_col).alias("doc_id"), *[F.col(n).alias(k) for k, n in names.items()]),
        "mix-facts",
    )
    cells = stored(facts.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    weights = cell_weights(cells, targets, budget_share)
    return facts.join(weights, list(DIMENSIONS)).select(
        "doc_id",
        *[F.nullif(F.col(d), F.lit(ABSENT)).alias(d) for d in DIMENSIONS],
        "tokens",
        "weight",
        "probability",
        (_draw(F.col("doc_id"), seed) < F.col("probability")).alias("sampled"),
        "deviation",
    )


def sample_mix(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    budget_share: float = 0.5,
    seed: int = 1,
    id_col: str = "doc_id",
    **columns,
) -> DataFrame:
    """The sampled rows of ``docs``, with all their columns."""
    read, names = with_facts(docs, **columns)
    own = [F.col(names[d]).alias(d) for d in DIMENSIONS]
    cells = stored(
        read.select(*own, F.col(names["tokens"]).alias("tokens"))
        .groupBy(*DIMENSIONS)
        .agg(F.sum("tokens").alias("tokens")),
        "mix-cells",
    )
    weights = cell_weights(cells, targets, budget_share).select(
        *[F.col(d).alias(f"{names[d]}_cell") for d in DIMENSIONS],
        F.col("probability").alias(f"{names['tokens']}_p"),
    )
    same = [F.col(names[d]) == F.col(f"{names[d]}_cell") for d in DIMENSIONS]
    drawn = _draw(F.col(id_col), seed) < F.col(f"{names['tokens']}_p")
    return read.join(weights, same).where(drawn).select(*docs.columns)
