"""Chunked running aggregates and exact quantiles against plain windows and numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from callsieve.operators.prefix import hash_numbered, numbered, previous_row, running
from callsieve.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds a third of the rows."""
    return spark.range(900).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"),
        F.pmod(F.hash("id"), F.lit(50)).cast("long").alias("v")).repartition(5)


@pytest.mark.parametrize("width", [1, 17, 10_000])
def test_running_equals_a_plain_window(rows, width):
    w = Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select("id", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"))
    got = running(rows, ["key"], [F.col("id")], F.floor(F.col("id") / width), sums={"s": F.col("v")}, maxes={"m": F.col("v")})
    assert sorted(got.select("id", "s", "m").collect()) == sorted(want.collect())


def test_running_before_the_row(rows):
    got = running(rows, [], [F.col("id")], F.floor(F.col("id") / 50), sums={"n": F.lit(1)}, before_row=True)
    assert sorted(r["n"] for r in got.collect()) == list(range(900))


def test_numbering_does_not_depend_on_partitions(rows):
    first = numbered(rows, ["key"], [F.col("id")], F.floor(F.col("id") / 10), "n").select("id", "n")
    again = numbered(rows.repartition(3), ["key"], [F.col("id")], F.floor(F.col("id") / 10), "n").select("id", "n")
    assert sorted(first.collect()) == sorted(again.collect())
    shuffled = sorted(hash_numbered(rows, [], "id", 42, "n").select("id", "n").collect())
    assert sorted(r["n"] for r in shuffled) == list(range(1, 901))
    assert shuffled == sorted(hash_numbered(rows.coalesce(1), [], "id", 42, "n").select("id", "n").collect())


def test_previous_row_equals_lag(rows):
    want = rows.select("id", F.lag("v").over(Window.partitionBy("key").orderBy("id")).alias("p"))
    got = previous_row(rows, ["key"], ["id"], F.floor(F.col("id") / 25), ["v"], "prev").select("id", F.col("prev.v").alias("p"))
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_quantiles_by_narrowing_equal_numpy(spark):
    random = np.random.default_rng(1)
    values = np.concatenate([np.full(400, 3.5), random.normal(0, 100, 500), random.exponential(1e6, 100), [-1e9]])
    df = spark.createDataFrame([(float(v), None if i % 2 else float(i)) for i, v in enumerate(values)], "a double, b double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.731, 0.99, 1.0]
    columns = {"a": F.col("a"), "b": F.col("b"), "none": F.lit(None).cast("double")}
    for accuracy in (20, 10_000):
        got = exact_quantiles(df, columns, probs, accuracy=accuracy)
        assert got["a"] == pytest.approx(list(np.quantile(values, probs)))
        assert got["b"] == pytest.approx(list(np.quantile(np.arange(0, len(values), 2), probs)))
        assert got["none"] == [None] * len(probs)


@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_quantiles_with_nan_infinities_and_wide_ranges(spark, accuracy):
    held = {"nan": [1.0, float("nan"), 2.0, 3.0], "inf": [float("-inf"), 1.0, 2.0, float("inf")], "two": [0.0, 0.0, 1.0, 1.0],
            "wide": [-1.7e308, 0.0, 5e-324, 1.7e308]}
    df = spark.createDataFrame(list(zip(*held.values())) * 50, ", ".join(f"{n} double" for n in held))
    got = exact_quantiles(df, {n: F.col(n) for n in held}, [0.0, 0.5, 1.0], accuracy=accuracy)
    assert got == {"nan": [1.0, 2.0, 3.0], "inf": [float("-inf"), 1.5, float("inf")], "two": [0.0, 0.5, 1.0],
                   "wide": [-1.7e308, 0.0, 1.7e308]}


def test_null_keys_and_order_values_keep_their_rows(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", None, 7), (None, 2, 1), (None, None, 2), ("a", 3, 1)], "k string, t int, v int")
    chunk = F.floor(F.col("t") / 2)
    got = running(rows, ["k"], [F.col("t")], chunk, sums={"s": F.col("v")}, maxes={"m": F.col("v")}).collect()
    assert sorted((r["k"] or "", r["t"] or 0, r["s"], r["m"]) for r in got) == [("", 0, 2, 2), ("", 2, 3, 2), ("a", 0, 7, 7), ("a", 1, 12, 7), ("a", 3, 13, 7)]
    got = previous_row(rows, ["k"], ["t"], chunk, ["v"], "p").collect()
    assert sorted((r["k"] or "", r["t"] or 0, r["p"] and r["p"]["v"]) for r in got) == [("", 0, None), ("", 2, 2), ("a", 0, None), ("a", 1, 7), ("a", 3, 5)]
