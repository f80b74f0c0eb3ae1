"""Text parsing, row flags and feature boundaries."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from callsieve.functions import text
from callsieve.operators import complaints as ops

SCHEMA = ("ticket_id long, caller_id string, date_of_issue string, time_of_issue string, issue string, call_type string,"
          " method string, state string, advertiser string")


def features(spark, rows):
    return {r["caller_id"]: r for r in ops.features(ops.clean(spark.createDataFrame(rows, SCHEMA))).collect()}


@pytest.mark.parametrize("value, hour", [
    ("1:00 pm", 13), ("8:08 PM", 20), ("2:30 p.m.", 14), ("14:30", 14), ("12:05 am", 0), ("12:05 pm", 12), ("13:00 pm", None),
    ("25:00 pm", None), ("5:75 pm", 17), ("1430", None), ("noon-ish", None), ("", None), (None, None)])
def test_parse_hour(spark, value, hour):
    assert spark.range(1).select(text.parse_hour(F.lit(value).cast("string"))).first()[0] == hour


@pytest.mark.parametrize("number, code, free", [
    ("866-410-0458", "866", True), ("+1-800-555-0000", "180", False), ("(888) 1", "888", True), ("12", None, False),
    (None, None, False)])
def test_area_code(spark, number, code, free):
    c = F.lit(number).cast("string")
    assert tuple(spark.range(1).select(text.area_code(c), text.is_toll_free(c)).first()) == (code, free)


def test_parse_date_formats(spark):
    texts = ["03/04/2017", "3/4/2017", "2017-03-04", "2017-03-04T00:00:00Z", "13/45/2017", "not_a_date", "03/04", None]
    df = spark.createDataFrame([(t,) for t in texts], "d string").select(F.date_format(text.parse_date(F.col("d")), "yyyy-MM-dd"))
    assert [r[0] for r in df.collect()] == ["2017-03-04"] * 4 + [None] * 4


def test_defaults_without_any_valid_field(spark):
    row = features(spark, [(1, "212-555-0000", None, None, None, None, None, None, None)])["212-555-0000"]
    got = [row[n] for n in ops.FEATURES[:5]]
    assert got == pytest.approx([0.5, 0.2, 0.1, 0.3, 2 / 7])
    assert (row["prerecorded_ratio"], row["is_voip"], row["complaint_velocity"]) == (0.0, 0.0, 1.0)
    assert row["complaint_count_log"] == pytest.approx(math.log(2))


def test_velocity_uses_whole_days(spark):
    base = (None, None, None, None, None, None)
    days = ["01/01/2017", "01/02/2017", "01/02/2017", "01/03/2017"]
    rows = [(i, "a", d, *base) for i, d in enumerate(days)] + [(i, "b", "01/01/2017", *base) for i in range(4)]
    got = features(spark, rows)
    assert (got["a"]["complaint_velocity"], got["b"]["complaint_velocity"]) == (2.0, 4.0)


def test_multi_caller_flag(spark):
    adv = lambda number, advertiser: (1, number, None, None, None, None, None, None, advertiser)
    got = features(spark, [adv("a", "a"), adv("b", "b"), adv("b", "c"), adv("c", None)])
    assert [got[k]["multi_caller_flag"] for k in "abc"] == [0.0, 1.0, 0.0]


def test_flag_boundaries(spark):
    # 2017-01-02 is a Monday, 2017-01-07 a Saturday.
    rows = [(1, "a", "01/02/2017", "9:00", "SLAMMING", "Autodialed Live Voice Call", "VoIP", "S", None),
            (2, "a", "01/02/2017", "17:00", "x", "Other", "Cell Phone", "S", None),
            (3, "a", "01/07/2017", "8:00", None, None, None, None, None),
            (4, "a", None, "22:00", None, None, None, None, None),
            (5, "a", None, "6:00", None, None, None, None, None)]
    got = {r["ticket_id"]: r for r in ops.row_flags(ops.clean(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert [got[i]["is_business"] for i in range(1, 6)] == [True, False, False, False, False]
    assert [got[i]["is_school"] for i in (1, 3)] == [True, False] and got[3]["is_weekend"]
    assert got[4]["is_night"] and not got[5]["is_night"] and not got[4]["is_evening"]
    assert got[1]["is_cramming"] and got[1]["is_live"] and got[1]["is_voip"] and got[2]["is_wireless"]


def test_out_of_range_dates_and_fake_numbers(spark):
    rows = [(1, "555-555-5555", None, None, None, None, None, None, None), (2, None, None, None, None, None, None, None, None),
            (3, "a", "12/31/2018", None, None, None, None, None, None), (4, "a", "01/01/1900", None, None, None, None, None, None)]
    got = {r["ticket_id"]: r["parsed_date"] for r in ops.clean(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {3, 4} and got[3] is not None and got[4] is None


def test_absent_columns_are_tolerated(spark):
    df = spark.createDataFrame([(1, "212-555-0000")], "ticket_id long, caller_id string")
    assert ops.features(ops.clean(df)).first()["is_wireless"] == 0.0
    assert ops.to_calls(df).first()["is_voip"] is False


def test_feature_vector_fills_gaps(spark):
    df = spark.createDataFrame([(1.5, None)], "a double, b double")
    assert df.select(ops.feature_vector(df, ["b", "a", "c"])).first()[0] == [0.0, 1.5, 0.0]
