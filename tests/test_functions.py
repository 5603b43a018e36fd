from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from curbline.config import Settings
from curbline.functions import times, values
from curbline.sources import calendar


def evaluate(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_utc_timestamp_applies_offsets_and_rejects_words(spark):
    got = evaluate(spark, [
        "2026-09-18T13:51:06Z", "2025-11-03T19:42:05+02:30", "2026-09-18", "2026-09-18 10:00:00.25",
        "yesterday", "12:30", "", "09/18/2026 01:51 PM", "2026-13-01", None], times.utc_timestamp)
    assert got == [
        datetime(2026, 9, 18, 13, 51, 6), datetime(2025, 11, 3, 17, 12, 5), datetime(2026, 9, 18),
        datetime(2026, 9, 18, 10, 0, 0, 250000), None, None, None, None, None, None]


def test_local_timestamp_keeps_the_wall_clock(spark):
    assert evaluate(spark, ["2026-03-10T10:00:00.000", "now"], times.local_timestamp) == [
        datetime(2026, 3, 10, 10), None]


def test_seconds_count_boundaries(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 1, 1, 10, 0, 0, 900000), datetime(2026, 1, 1, 10, 0, 1, 100000))],
        "a timestamp_ntz, b timestamp_ntz")
    row = df.select(
        times.seconds_between(F.col("a"), F.col("b")).alias("s"),
        times.millis_between(F.col("a"), F.col("b")).alias("ms"),
        times.hours_between(F.col("b"), F.col("a")).alias("h")).head()
    assert (row.s, row.ms, row.h) == (1, 200, -1 / 3600)


def test_lenient_int_rounds_halves_away_from_zero(spark):
    assert evaluate(spark, ["27", "27.0", "26.5", "27.5", "-2.5", "x", "", None, "9e99"],
                    values.lenient_int) == [27, 27, 27, 28, -3, None, None, None, None]


def test_lenient_bool(spark):
    assert evaluate(spark, ["true", "FALSE", "maybe", None], values.lenient_bool) == [
        True, False, None, None]


def test_json_text(spark):
    got = evaluate(spark, ['{"group":"D1"}', '{"group":null}', "{}", "nope", '{"group":5}'],
                   lambda c: values.json_text(c, "group"))
    assert got == ["D1", None, None, None, "5"]


def test_thresholds_and_ranks(spark):
    labels = ["Critical", "High", "Medium", "Low", "Unknown", None]
    assert evaluate(spark, labels, values.threshold_hours) == [4, 24, 72, 168, None, None]
    assert evaluate(spark, labels, values.tier_rank) == [3, 2, 1, 0, None, None]
    custom = Settings(sla_thresholds={"High": 1})
    assert evaluate(spark, ["High", "Low"], lambda c: values.threshold_hours(c, custom)) == [1, None]


def test_ratio_is_null_without_a_denominator(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (1, None)], "a long, b long")
    assert [r[0] for r in df.select(values.ratio(F.col("a"), F.col("b"))).collect()] == [0.25, None, None]


def test_normalised_label(spark):
    assert evaluate(spark, ["  hIGH ", "low\n", "Critical"], values.normalised_label) == [
        "High", "Low", "Critical"]


def test_prompt_and_trace_are_deterministic(spark):
    df = spark.createDataFrame([("Pothole", "c1", "open", "1 Main")], "n string, c string, s string, a string")
    text = df.select(values.prompt_text(*[F.col(c) for c in "ncsa"])).head()[0]
    assert text.splitlines()[1:] == [
        "- service_name: Pothole", "- service_code: c1", "- status: open", "- address: 1 Main"]
    assert df.select(values.trace_id(F.col("c"))).head() == df.select(values.trace_id(F.col("c"))).head()
    tags = df.select(values.trace_tags(F.col("n"), F.col("c")).alias("t"),
                     values.trace_metadata(F.col("a"), F.col("c"), F.col("n")).alias("m")).head()
    assert tags.t == ["Pothole", "c1", "urgency_classification"]
    assert tags.m.prompt_version == "v1"


def test_fiscal_calendar(spark):
    cal = calendar.fiscal_calendar(spark, 2025, 2027)
    assert cal.count() == 1095
    by_day = {r.calendar_date: r for r in cal.collect()}
    first = by_day[date(2025, 10, 1)]
    assert (first.fiscal_year, first.fiscal_quarter, first.fiscal_month) == (2026, 1, 1)
    assert (first.month_start, first.week_start, first.week_end, first.day_of_week) == (
        date(2025, 10, 1), date(2025, 9, 29), date(2025, 10, 5), 3)
    last = by_day[date(2026, 9, 30)]
    assert (last.fiscal_year, last.fiscal_quarter, last.fiscal_month) == (2026, 4, 12)
    assert by_day[date(2026, 1, 31)].fiscal_month == 4
    assert by_day[date(2025, 11, 30)].fiscal_month == 2


def test_windows(spark):
    assert times.fiscal_year_bounds(2026) == (date(2025, 10, 1), date(2026, 9, 30))
    assert calendar.resolve_window(fiscal_year=2026, last_days=30) == (
        "fy2026-last30d", date(2026, 9, 1), date(2026, 9, 30))
    assert calendar.resolve_window(start=date(2026, 3, 10)) == (
        "custom", date(2026, 3, 10), date(2026, 3, 10))
    with pytest.raises(ValueError):
        calendar.resolve_window()
    plan = calendar.partition_plan(spark, start=date(2026, 3, 10), end=date(2026, 3, 12)).collect()
    assert [r.partition_date.day for r in plan] == [10, 11, 12]
    assert plan[0].where_clause == (
        "created_date >= '2026-03-10T00:00:00' AND created_date < '2026-03-11T00:00:00'")
