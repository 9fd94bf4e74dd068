"""Exact ranks and quantiles inside groups of any size.

A window ordered over a whole group would sort that group in one task. Instead the
ranks are prefix sums over a radix histogram:

1. one aggregation counts the rows of every (group, value), per task first, so a value
   that many rows share is one row from there on;
2. the leading digit of a value, its sign, exponent and first bits of the fraction,
   keeps the order of values. Counts per group and digit, summed up in order, tell how
   many rows lie below each digit; there are at most 2^24 of them whatever the rows;
3. a digit with more than ``BIN_VALUES`` values is refined by the next bits in the
   same way. What is left of a value after two digits has 2^20 possibilities, which
   bounds every ordered window;
4. the rows of the group below a value are the sum of the three parts, exactly, and
   each row meets the rank of its value in one join. The rows are read twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN_VALUES = 1 << 14
FIRST_BITS, NEXT_BITS = 12, 20  # of the 52 bits of a fraction
LEAST_EXPONENT = -1022


def _right(key: str) -> str:
    return f"_right_{key}"


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys, NULLs too; ``right`` has them under other names."""
    return reduce(lambda a, b: a & b, [left[key].eqNullSafe(right[_right(key)]) for key in keys])


def with_digits(df: DataFrame, value: str) -> DataFrame:
    """Append ``_first`` and ``_next``, the digits of a double; pairs of them never order
    against the values. NULL lies below all numbers and NaN above, as in an ordering.

    The logarithm may be off by one next to a power of two, which a comparison mends.
    Scaling by a power of two is exact, so digits are those of the number itself.
    """
    huge, fraction = 1 << 40, 1 << FIRST_BITS
    steps = {
        "_double": f"double(`{value}`)",
        "_size": "abs(_double)",
        "_near": "int(least(floor(log2(_size)), 1023))",
        "_power": "pow(2D, _near)",
        "_exponent": f"""CASE WHEN _size < double('{2.0**LEAST_EXPONENT!r}') THEN {LEAST_EXPONENT}
            WHEN _size < _power THEN _near - 1 WHEN _size / 2D >= _power THEN _near + 1 ELSE _near END""",
        "_part": f"_size / pow(2D, _exponent) * {fraction}D",
        "_sign": "CASE WHEN _double < 0 THEN -1L ELSE 1L END",
        "_first": f"""CASE WHEN _double IS NULL THEN -{2 * huge}L WHEN isnan(_double) THEN {2 * huge}L
            WHEN _size = double('Infinity') THEN _sign * {huge}L
            ELSE _sign * (bigint(_exponent - {LEAST_EXPONENT}) * {2 * fraction}L + floor(_part) + 1L) END""",
        "_next": f"""CASE WHEN _double IS NULL OR isnan(_double) OR _size = double('Infinity') THEN 0L
            ELSE _sign * floor((_part - floor(_part)) * {1 << NEXT_BITS}D) END""",
    }
    return df.selectExpr("*", *[f"{step} AS {name}" for name, step in steps.items()]).select(
        *df.columns, "_first", "_next"
    )


def value_ranks(
    df: DataFrame, group: Sequence[str], value: str, bin_values: int = BIN_VALUES
) -> DataFrame:
    """Per group and distinct value: ``rows``, ``below`` (rows with a smaller value, NULL
    smallest), ``group_rows`` and ``group_nulls``. ``df`` is read once."""
    group = list(group)
    counts = with_digits(df.groupBy(*group, value).agg(F.count("*").alias("rows")), value)

    def sum_below(rows: str, over: Sequence[str], digit: str) -> Column:
        return F.sum(rows).over(Window.partitionBy(*over).orderBy(digit)) - F.col(rows)

    whole, first_key = Window.partitionBy(*group), [*group, "_first"]
    nulls = F.sum(F.when(F.col(value).isNull(), F.col("rows")).otherwise(0))
    firsts = (
        counts.groupBy(*first_key)
        .agg(F.sum("rows").alias("_rows"), F.count("*").alias("_values"), nulls.alias("_nulls"))
        .select(
            *[F.col(c).alias(_right(c)) for c in first_key],
            (F.col("_values") > bin_values).alias("_large"),
            sum_below("_rows", group, "_first").alias("_below_first"),
            F.sum("_rows").over(whole).alias("group_rows"),
            F.sum("_nulls").over(whole).alias("group_nulls"),
        )
    )
    kept = [*group, value, "rows", "_first", "_large", "_below_first", "group_rows", "group_nulls"]
    keyed = counts.join(firsts, _same(counts, firsts, first_key)).select(
        *kept, F.when(F.col("_large"), F.col("_next")).otherwise(F.lit(0)).alias("_next")
    )
    next_key = [*first_key, "_next"]
    nexts = (
        keyed.where("_large")
        .groupBy(*next_key)
        .agg(F.sum("rows").alias("_rows"))
        .select(
            *[F.col(c).alias(_right(c)) for c in next_key],
            sum_below("_rows", first_key, "_next").alias("_below_next"),
        )
    )
    inside = sum_below("rows", next_key, value)
    below = F.col("_below_first") + F.coalesce("_below_next", F.lit(0)) + inside
    return keyed.join(nexts, _same(keyed, nexts, next_key), "left").select(
        *group, value, "rows", below.alias("below"), "group_rows", "group_nulls"
    )


def rows_below(
    df: DataFrame, group: Sequence[str], value: str, bin_values: int = BIN_VALUES
) -> DataFrame:
    """Append ``below`` (rows of the group with a smaller value, NULL smallest)
    and ``group_rows``, ``group_nulls``.

    ``df`` is read twice and should be a stored table or cheap to recompute.
    """
    key, found = [*group, value], ("below", "group_rows", "group_nulls")
    ranks = value_ranks(df, group, value, bin_values)
    ranks = ranks.select(*[F.col(c).alias(_right(c)) for c in key], *found)
    return df.join(ranks, _same(df, ranks, key)).select(*df.columns, *found)


def percent_ranks(
    df: DataFrame,
    group: Sequence[str],
    key: Sequence[str],
    metrics: dict[str, str],
    bin_values: int = BIN_VALUES,
) -> DataFrame:
    """``PERCENT_RANK() * 100`` of several metrics within the same groups, NULL lowest.

    ``metrics`` maps an output column to its source column. Returns ``group``,
    ``key`` and the output columns, one row per key. All metrics share one pass
    over a long (row, metric, value) form.
    """
    ids = list(dict.fromkeys([*group, *key]))
    long = df.select(*ids, *metrics.values()).unpivot(
        ids, list(metrics.values()), "_metric", "_value"
    )
    ranked = rows_below(long, [*group, "_metric"], "_value", bin_values)
    others = F.col("group_rows") - F.lit(1)
    share = F.when(others > 0, F.col("below").cast("double") / others).otherwise(F.lit(0.0))
    ranked = ranked.withColumn("_share", share * F.lit(100))
    return ranked.groupBy(*ids).agg(
        *[
            F.max(F.when(F.col("_metric") == source, F.col("_share"))).alias(out)
            for out, source in metrics.items()
        ]
    )


def group_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    bin_values: int = BIN_VALUES,
) -> DataFrame:
    """Exact interpolated quantiles of the non-NULL values, one row per group.

    The i-th smallest value is the largest one with at most i values below it,
    so once ``below`` is known every quantile is a plain maximum over the distinct
    values. Between two values the weights are those of the built-in exact percentile.
    """
    present = value_ranks(df.where(F.col(value).isNotNull()), group, value, bin_values)
    last = F.col("group_rows") - F.lit(1)
    aggregates = []
    for name, p in probabilities.items():
        at = last * F.lit(float(p))
        low = F.max(F.when(F.col("below") <= F.floor(at), F.col(value)))
        high = F.max(F.when(F.col("below") <= F.ceil(at), F.col(value)))
        to_low, to_high = F.max(F.ceil(at) - at), F.max(at - F.floor(at))
        between = to_low * low + to_high * high
        aggregates.append(F.when(low == high, low).otherwise(between).alias(name))
    return present.groupBy(*group).agg(*aggregates)
