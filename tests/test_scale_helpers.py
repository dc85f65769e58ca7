"""Helpers that keep large groups out of single tasks, against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyloom.operators.ordering import contiguous_runs, with_following, with_group_index, with_row_index
from skyloom.operators.quantiles import aggregate_with_quantiles, grouped_quantiles, hot_quantiles
from skyloom.operators.skew import pick_first, pick_last

PROBS = [0.0, 0.16, 0.25, 0.5, 0.84, 1.0]


def skewed(seed=1):
    rng = np.random.default_rng(seed)
    parts = [
        pd.DataFrame({"k": 1, "v": rng.normal(17, 0.3, 4000)}),
        pd.DataFrame({"k": 2, "v": np.repeat(5.0, 3000)}),
        pd.DataFrame({"k": 3, "v": np.concatenate([np.exp(rng.normal(0, 4, 2500)), [1e9, -1e9]])}),
        pd.DataFrame({"k": 4, "v": rng.integers(0, 7, 900).astype(float)}),
        pd.DataFrame({"k": 5, "v": [1.0, 2.0, 4.0]}),
    ]
    return pd.concat(parts).sample(frac=1.0, random_state=seed)


@pytest.mark.parametrize("limit", [1, 1000, 10_000_000])
def test_quantiles_match_numpy(spark, hot, limit):
    pdf = skewed()
    df = spark.createDataFrame(pdf)
    with hot(limit):
        out = {r["k"]: r for r in aggregate_with_quantiles(df, ["k"], [F.count("*").alias("n")], {"q": ("v", PROBS)}).collect()}
    assert set(out) == {1, 2, 3, 4, 5}
    for k, g in pdf.groupby("k"):
        assert out[k]["n"] == len(g)
        np.testing.assert_allclose(out[k]["q"], np.quantile(g["v"], PROBS), rtol=1e-12, atol=1e-9)


def test_whole_table_quantile_is_split_too(spark, hot):
    pdf = skewed(2)
    with hot(500):
        got = aggregate_with_quantiles(spark.createDataFrame(pdf), [], [], {"q": ("v", PROBS)}).collect()
    np.testing.assert_allclose(got[0]["q"], np.quantile(pdf["v"], PROBS), rtol=1e-12, atol=1e-9)


def test_hot_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (1, float("nan")), (1, 3.0)], "k int, v double")
    assert hot_quantiles(df, ["k"], "v", [0.5], "q").first()["q"] == [2.0]


def test_one_hot_group_beside_cold_ones(spark, hot):
    pdf = skewed(3)
    with hot(3500):
        out = {r["k"]: r["q"][0] for r in grouped_quantiles(spark.createDataFrame(pdf), ["k"], "v", [0.5]).collect()}
    for k, g in pdf.groupby("k"):
        assert out[k] == pytest.approx(np.median(g["v"]))


def test_row_index_is_consecutive_in_order(spark):
    rng = np.random.default_rng(0)
    values = rng.permutation(5000)
    df = spark.createDataFrame([(int(v), int(v) % 3) for v in values], "v long, k int").repartition(7)
    rows = with_row_index(df, ["v"]).collect()
    assert sorted((r["idx"], r["v"]) for r in rows) == [(i, i) for i in range(5000)]
    grouped = with_group_index(df, ["k"], ["v"]).collect()
    for k in range(3):
        mine = sorted((r["v"], r["idx"]) for r in grouped if r["k"] == k)
        assert [i for _, i in mine] == list(range(len(mine)))


def test_following_rows_cross_chunks(spark):
    df = spark.range(1000).select(F.col("id").alias("idx"), (F.col("id") * 10).alias("v"))
    rows = {r["idx"]: (r["v1"], r["v2"]) for r in with_following(df, ["v"], 2, chunk=7).collect()}
    assert len(rows) == 1000
    for i in range(1000):
        assert rows[i] == ((i + 1) * 10 if i < 999 else None, (i + 2) * 10 if i < 998 else None)


def test_contiguous_runs(spark):
    df = spark.createDataFrame([("a", x) for x in (1, 2, 3, 7, 8, 8, 20)] + [("b", x) for x in (21, 22)], "k string, x int")
    got = sorted((r["k"], r["first"], r["last"], r["length"]) for r in contiguous_runs(df, ["k"], "x").collect())
    assert got == [("a", 1, 3, 3), ("a", 7, 8, 2), ("a", 20, 20, 1), ("b", 21, 22, 2)]


def test_pick_first_and_last_keep_whole_rows(spark):
    df = spark.createDataFrame([(1, 3, "c", None), (1, 1, "a", 5), (1, 2, "b", 6), (2, 9, None, 7)], "k int, o int, s string, n int")
    assert {r["k"]: (r["o"], r["s"], r["n"]) for r in pick_first(df, ["k"], [F.col("o")]).collect()} == {1: (1, "a", 5), 2: (9, None, 7)}
    assert {r["k"]: (r["o"], r["s"], r["n"]) for r in pick_last(df, ["k"], [F.col("o")]).collect()} == {1: (3, "c", None), 2: (9, None, 7)}
