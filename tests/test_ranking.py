"""Distributed ranks and quantiles against plain windows and numpy."""

import math
import random
import struct

import numpy as np
import pytest
from conftest import plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerstrata.operators.ranking import group_quantiles, percent_ranks, rows_below, value_ranks, with_digits


def reference(df):
    w = Window.partitionBy("g").orderBy(F.asc_nulls_first("v"))
    return df.select("g", "k", (F.percent_rank().over(w) * 100).alias("p"))


def frame(spark, values):
    rows = [(g, i, v) for i, (g, v) in enumerate(values)]
    return spark.createDataFrame(rows, "g string, k int, v double")


def same(left, right):
    key = lambda r: (r.g, r.k)
    a = [tuple(r) for r in sorted(left.select("g", "k", "p").collect(), key=key)]
    b = [tuple(r) for r in sorted(right.select("g", "k", "p").collect(), key=key)]
    return a == b


values = st.one_of(st.none(), st.integers(-3, 3).map(float), st.floats(-1e6, 1e6))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), values), min_size=1, max_size=60))
def test_percent_rank_matches_window(spark, rows):
    df = frame(spark, rows)
    for bin_values in (0, 2):
        assert same(percent_ranks(df, ["g"], ["k"], {"p": "v"}, bin_values=bin_values), reference(df))
    assert same(percent_ranks(df, ["g"], ["k"], {"p": "v"}), reference(df))


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_hot_group_hot_value(spark, threshold):
    """One group holds most rows and one value a third of them; also without broadcasts."""
    rng = random.Random(5)
    rows = [("hot", 7.0 if i % 3 == 0 else rng.random() * 100) for i in range(6000)]
    rows += [("cold", rng.random()) for _ in range(50)] + [("one", 1.0), ("hot", None)]
    df = frame(spark, rows)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = percent_ranks(df, ["g"], ["k"], {"p": "v"}, bin_values=100)
        assert same(out, reference(df))
        # No list of values is gathered, and values are ordered inside a digit, never in a group.
        text = plan(rows_below(df, ["g"], "v"))
        assert "collect_list" not in text
        windows = [line for line in text.splitlines() if "Window [" in line and "v#" in line.split("],")[-1]]
        assert windows and all("_first" in line and "_next" in line for line in windows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_the_rows_are_read_twice(spark, scratch):
    frame(spark, [("a", float(i % 7)) for i in range(100)]).write.parquet(f"{scratch}/t")
    df = spark.read.schema("g string, k int, v double").parquet(f"{scratch}/t")
    out = rows_below(df, ["g"], "v")
    out.collect()
    text = plan(out).split("== Initial Plan ==")[0]
    assert text.count("FileScan") <= 2 and "ReusedExchange" in text
    assert plan(group_quantiles(df, ["g"], "v", {"m": 0.5})).count("FileScan") >= 1


def ordered(values):
    return sorted(values, key=lambda x: (x is not None, x is not None and math.isnan(x), 0.0 if x is None or math.isnan(x) else x))


def test_digits_keep_the_order(spark):
    rng = random.Random(8)
    edges = [2.0**e for e in (-1074, -1073, -1030, -1023, -1022, -1021, -3, 0, 1, 52, 53, 1023)]
    edges += [math.nextafter(x, y) for x in edges for y in (0.0, math.inf)] + [0.0, -0.0, math.inf, 1.7976931348623157e308]
    some = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(4000)]
    some = [x for x in some if not math.isnan(x)] + [rng.random() for _ in range(1000)]
    every = [*edges, *[-x for x in edges], *some, None, math.nan]
    df = spark.createDataFrame([(x,) for x in every], "v double")
    found = {r.v if r.v is None or r.v == r.v else "nan": (r["_first"], r["_next"]) for r in with_digits(df, "v").collect()}
    pairs = [found["nan" if x is not None and math.isnan(x) else x] for x in ordered(every)]
    assert all(p <= q for p, q in zip(pairs, pairs[1:]))
    # Two digits tell nearly all numbers apart.
    assert len(set(pairs)) > 0.99 * len(set(some))


def test_odd_numbers_rank_as_in_a_window(spark):
    odd = [math.nan, math.inf, -math.inf, 0.0, -0.0, 5e-324, -5e-324, None, None, 1.0, math.nan, 1e308, -1e308]
    df = frame(spark, [("a", v) for v in odd])
    for bin_values in (0, 1 << 14):
        assert same(percent_ranks(df, ["g"], ["k"], {"p": "v"}, bin_values=bin_values), reference(df))


def test_quantiles_match_numpy(spark):
    rng = random.Random(9)
    data = {
        "a": [rng.gauss(0, 10) for _ in range(501)],
        "b": [float(rng.randint(0, 3)) for _ in range(64)],
        "c": [2.5],
    }
    df = frame(spark, [(g, v) for g, vs in data.items() for v in [*vs, None]])
    probabilities = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q90": 0.9, "q100": 1.0}
    exact = df.groupBy("g").agg(
        F.percentile("v", F.array(*[F.lit(p) for p in probabilities.values()])).alias("q")
    )
    want = {row.g: row.q for row in exact.collect()}
    for bin_values in (0, 3, 1 << 16):
        out = group_quantiles(df, ["g"], "v", probabilities, bin_values=bin_values)
        for row in out.collect():
            # To the last bit, whatever the digits.
            assert [row[name] for name in probabilities] == want[row.g]
            for name, p in probabilities.items():
                assert row[name] == pytest.approx(np.quantile(data[row.g], p), abs=1e-9)


def test_a_dense_group_is_spread_over_digits(spark):
    """Values between 1 and 2 share sign and exponent; no ordered window holds many of them."""
    df = frame(spark, [("hot", 1 + i / 40_000) for i in range(20_000)])
    ranks = value_ranks(df, ["g"], "v", bin_values=50)
    assert ranks.where("below <> round((v - 1) * 40000)").count() == 0
    sizes = with_digits(df, "v").groupBy("_first").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < 50 and sizes[1] > 2_000
    near = frame(spark, [("hot", 1 + i * 2.0**-40) for i in range(20_000)])
    assert with_digits(near, "v").groupBy("_first").count().count() == 1  # one first digit, spread by the next
    assert with_digits(near, "v").groupBy("_first", "_next").count().agg(F.max("count")).first()[0] <= 512
    ranks = value_ranks(near, ["g"], "v", bin_values=50)
    assert ranks.where("below <> round((v - 1) * pow(2, 40))").count() == 0


def test_building_a_plan_runs_nothing(spark):
    df = frame(spark, [("a", 1.0)] * 5 + [("b", 2.0)] * 3)
    spark.sparkContext.setJobGroup("plan-only", "no job may start")
    try:
        percent_ranks(df, ["g"], ["k"], {"p": "v"}).schema
        group_quantiles(df, ["g"], "v", {"m": 0.5}).schema
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
