"""File sources and sinks, and dirty-data injection."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from callsieve.operators import inject, profile
from callsieve.sources import files


def test_csv_scan_skips_long_rows_and_keeps_short_ones(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text('a,b,c\n1,2,3\n1,2\n1,2,3,4\n"x,y",5,6\n')
    got = files.scan_csv(spark, str(path), ["a", "b", "c"])
    assert sorted(map(tuple, got.collect()), key=str) == [("1", "2", "3"), ("1", "2", None), ("x,y", "5", "6")]


def test_complaint_scan_renames_the_header(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(",".join(f'"{c}"' for c in files.COMPLAINT_COLUMNS) + "\n" + ",".join("abcdefghijklmn") + "\n")
    row = files.scan_complaints(spark, str(path)).first()
    assert (row["caller_id"], row["call_type"], row["location"]) == ("h", "i", "n")


def test_typed_scan(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("n,s\n1.5,a\nbad,b\n")
    got = files.scan_csv_typed(spark, str(path), {"n": "double", "absent": "int"})
    assert sorted(map(tuple, got.collect()), key=str) == [(1.5, "a"), (None, "b")]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "i int, s string")
    files.write_csv(df, str(tmp_path / "csv"))
    files.write_json(df, str(tmp_path / "json"))
    assert files.scan_csv_typed(spark, str(tmp_path / "csv"), {"i": "int"}).filter("s = 'a,b'").count() == 1
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    with pytest.raises(Exception):
        files.write_csv(df, str(tmp_path / "csv"))  # nothing is overwritten silently


def test_missing_table_reads_as_none(spark, tmp_path):
    assert files.read_or_none(spark, str(tmp_path / "nothing")) is None


def table(spark):
    return spark.range(500).select(
        F.col("id").alias("ticket_id"), F.when(F.col("id") % 10 != 0, F.concat(F.lit("212-555-"), F.col("id"))).alias("caller_id"),
        F.lit("Wired").alias("method"), F.lit("CA").alias("state"))


def test_missing_cells_are_exact_and_repeatable(spark):
    got = inject.inject_missing(table(spark), "ticket_id", "heavy")
    rate = inject.rate(inject.PROFILES["heavy"]["missing"], inject.MISSING_WEIGHTS["caller_id"])
    assert got.filter("caller_id is null").count() == 50 + math.floor(450 * rate)
    again = inject.inject_missing(table(spark).repartition(7), "ticket_id", "heavy")
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))


def test_wrong_values_are_exact(spark):
    got = inject.inject_errors(table(spark), "ticket_id", "light")
    rate = inject.rate(inject.PROFILES["light"]["error"], inject.ERROR_WEIGHTS["state"])
    assert got.filter("state <> 'CA'").count() == math.floor(500 * rate)
    assert got.filter("caller_id is null").count() == 50


def test_corruption_report(spark):
    before = table(spark)
    after = inject.corrupt(before, "ticket_id", "medium")
    assert after.count() == 500 + 15 + 5
    assert profile.duplicates(after).first()["duplicates"] == 15
    found = {r["column"]: r for r in inject.corruption_delta(before, after, "ticket_id").collect()}
    delta = {c: r["delta_pct"] for c, r in found.items()}
    assert found["method"]["n_emptied"] == 90 and found["state"]["n_wrong"] > 0 and found["ticket_id"]["injected_pct"] == 0
    assert delta["method"] > 10 and delta["ticket_id"] == 0
