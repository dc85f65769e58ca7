"""Neighbouring rows of an ordered table against numpy, at its ends, on its knots and with one frequent value."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import stellar
from skyloom.operators.bracket import between, bracket_join


@pytest.mark.parametrize("parts", [1, 7])
def test_interpolation_matches_numpy(spark, parts):
    rng = np.random.default_rng(parts)
    tables = {k: np.sort(np.unique(rng.uniform(-5, 5, n).round(2))) for k, n in (("a", 30), ("b", 1), (None, 500))}
    values = {k: rng.normal(0, 1, len(v)) for k, v in tables.items()}
    rows = [(i, rng.choice(["a", "b", None, "c"]), float(rng.uniform(-6, 6))) for i in range(900)]
    rows += [(1_000 + i, "a", 0.25) for i in range(600)] + [(2_000 + i, "a", float(x)) for i, x in enumerate(tables["a"])]
    rows += [(3_000, "a", None), (3_001, "a", float("nan")), (3_002, "b", float(tables["b"][0])), (3_002, "b", float(tables["b"][0]))]
    table = [(k, float(x), float(v)) for k in tables for x, v in zip(tables[k], values[k])] + [("a", None, 1.0), ("a", float(tables["a"][3]), -1e9)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        out = bracket_join(spark.createDataFrame(rows, "id long, k string, lower_x double"), spark.createDataFrame(table, "k string, at double, v double"), "lower_x", "at", ["v"], ["k"])
        got = out.select("id", "k", "lower_x", between("v", "lower_x", "at").alias("y"), "lower", "upper").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(r["id"] for r in got) == sorted(r[0] for r in rows)
    for r in got:
        knots, own, x = tables.get(r["k"], np.zeros(0)), values.get(r["k"]), r["lower_x"]
        if r["k"] == "c" or x is None or np.isnan(x):
            assert r["lower"] is None and r["upper"] is None and r["y"] is None
            continue
        n = np.searchsorted(knots, x, side="right")
        assert (r["lower"]["at"] if n else r["lower"]) == (knots[n - 1] if n else None)
        assert (None if r["upper"] is None else r["upper"]["at"]) == (knots[n] if n and n < len(knots) else None)
        if len(knots) and knots[0] <= x <= knots[-1]:
            assert r["y"] == pytest.approx(float(np.interp(x, knots, own)), abs=1e-9)
        else:
            assert r["y"] is None


def test_empty_sides(spark):
    rows, table = spark.createDataFrame([(1, 2.0)], "id long, x double"), spark.createDataFrame([(0.0, 1.0)], "at double, v double")
    assert bracket_join(rows, table.limit(0), "x", "at", ["v"]).select("lower", "upper").collect() == [(None, None)]
    assert bracket_join(rows.limit(0), table, "x", "at", ["v"]).collect() == []


def test_published_tables_are_rising_and_whole():
    rows = stellar.colour_rows()
    for name, size in (("dwarf", 25), ("giant", 16)):
        own = [r for r in rows if r[0] == name]
        assert len(own) == size and all(a[1] < b[1] for a, b in zip(own, own[1:])) and {len(r) for r in own} == {9}
        # J−K is J−H plus H−K within rounding of the table
        assert all(abs(r[5] - r[3] - r[4]) <= 0.016 for r in own)
