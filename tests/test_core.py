"""Scalars, state, early stop and the calendar on literal fixtures."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from bondlake import dims
from bondlake.functions import dates as D
from bondlake.functions.numerals import spell
from bondlake.operators import state as S, stats as A
from bondlake.sources.pages import listing_rows

# Published gaps with the public holiday schedule of the years around them.
OFF = ["2019-09-13", *[f"2019-10-0{d}" for d in (1, 2, 3, 4, 7)], "2020-01-01", "2020-01-24", *[f"2020-01-{d}" for d in (27, 28, 29, 30, 31)], "2020-04-06", "2020-05-01", "2020-05-04", "2020-05-05", "2020-06-25", "2020-06-26", "2020-10-01", "2020-10-02", *[f"2020-10-0{d}" for d in (5, 6, 7, 8)], "2023-09-29", *[f"2023-10-0{d}" for d in (2, 3, 4, 5, 6)], *[f"2024-05-0{d}" for d in (1, 2, 3)], "2024-06-10", "2024-09-16", "2024-09-17", *[f"2024-10-0{d}" for d in (1, 2, 3, 4, 7)]]
ON = ["2019-09-29", "2019-10-12", "2020-01-19", "2020-04-26", "2020-05-09", "2020-06-28", "2020-09-27", "2020-10-10", "2023-10-07", "2023-10-08", "2024-04-28", "2024-05-11", "2024-09-14", "2024-09-29", "2024-10-12"]
GOLDEN = [("2019-06-21", "2020-06-29", 253), ("2020-06-03", "2020-12-19", 137), ("2024-04-18", "2024-10-27", 130), ("2023-07-02", "2023-11-29", 104), ("2020-06-03", "2020-10-30", 102), ("2023-07-02", "2023-11-10", 91), ("2023-07-02", "2023-11-05", 86), ("2020-06-03", "2020-09-10", 70), ("2019-02-22", "2019-02-25", 1), ("2020-02-27", "2020-02-28", 1), ("2023-08-22", "2023-08-23", 1), ("2024-03-15", "2024-03-18", 1)]


def days(xs):
    return [date.fromisoformat(x) for x in xs]


def test_golden_workday_gaps(spark):
    cal = dims.calendar(spark, date(2019, 1, 1), date(2024, 12, 31), days(OFF), days(ON))
    x = spark.createDataFrame([(date.fromisoformat(a), date.fromisoformat(b), n) for a, b, n in GOLDEN], "a date, b date, n int")
    x = D.with_workday_gap(x, cal, "a", "b", "gap")
    formula = D.workdays_by_formula(F.col("a"), F.col("b"), F.array(*[F.lit(d) for d in days(OFF)]), F.array(*[F.lit(d) for d in days(ON)]))
    for r in x.withColumn("formula", formula).collect():
        assert r.gap == r.n == r.formula


def test_gap_edges(spark):
    cal = dims.calendar(spark, date(2024, 1, 1), date(2024, 1, 31))
    x = spark.createDataFrame([(date(2030, 1, 1), date(2030, 1, 1)), (date(2024, 1, 5), date(2024, 1, 4)), (date(2024, 1, 5), date(2024, 2, 20)), (None, date(2024, 1, 5))], "a date, b date")
    assert [r.gap for r in D.with_workday_gap(x, cal, "a", "b", "gap").collect()] == [0, None, None, None]


def test_keep_last_is_idempotent_and_associative(spark):
    x = spark.createDataFrame([(1, "u", None), (2, "u", None), (3, "v", 1), (4, None, 1), (5, None, 1)], "seq int, url string, k int")
    one = S.keep_last(x, ["url", "k"], "seq")
    assert sorted(r.seq for r in one.collect()) == [2, 3, 5]
    assert sorted(r.seq for r in S.keep_last(one, ["url", "k"], "seq").collect()) == [2, 3, 5]
    half = S.merge(S.keep_last(x.filter("seq < 3"), ["url", "k"], "seq"), x.filter("seq >= 3"), ["url", "k"], "seq")
    assert sorted(r.seq for r in half.collect()) == [2, 3, 5]
    assert S.keep_last(x.limit(0), ["url"], "seq").collect() == []


def test_range_join_equals_nested_loop(spark):
    plans = spark.createDataFrame([(1, "p", date(2024, 1, 1), date(2024, 3, 31), date(2023, 12, 1)), (2, "p", date(2024, 2, 1), date(2024, 2, 29), None), (3, None, date(2024, 1, 1), date(2024, 1, 31), date(2024, 1, 1))], "plan_id int, province string, covered_period_start date, covered_period_end date, pub_date date")
    anns = spark.createDataFrame([("p", date(2024, 2, 10)), ("p", date(2024, 4, 1)), (None, date(2024, 1, 5)), ("p", date(2024, 3, 31))], "province string, bid_date date")
    got = sorted((r[0], r[1]) for r in A.range_join(plans, anns).select("p.plan_id", "a.bid_date").collect())
    assert got == [(1, date(2024, 2, 10)), (1, date(2024, 3, 31)), (2, date(2024, 2, 10))]


def test_spelling():
    assert [spell(n) for n in (0, 10, 11, 20, 105, 110, 999)] == ["零", "十", "十一", "二十", "一百零五", "一百一十", "九百九十九"]


@pytest.mark.parametrize("html,n", [("", 0), ("<div id='to-print1'></div>", 0), ("<div id='to-print1'><li><a href='x'>t<li><a href='y'>s</div>", 2)])
def test_listing_of_odd_markup(html, n):
    assert len(listing_rows(html)) == n


def test_report_renders(spark, tmp_path):
    from bondlake.plans.report import main

    page = tmp_path / "page.html"
    page.write_text("a /* plans begin */ /* plans end */ b /* calendar begin */\n{}\n/* calendar end */", encoding="utf-8")
    day = spark.read.parquet("/root/testdata/sf0.001/state_plans.parquet").agg(F.max("covered_period_start")).first()[0]
    assert main(["/root/testdata/sf0.001", str(tmp_path), "--raw", "--page", str(page), "--as-of", day.isoformat()]) == 0
    assert '"monthLabel"' in page.read_text(encoding="utf-8") and f'"{day.year}年{day.month}月"' in page.read_text(encoding="utf-8")
    assert spark.read.parquet(str(tmp_path / "detail")).count() == spark.read.parquet("/root/testdata/sf0.001/state_announcements.parquet").count()
    assert "## by_region" in (tmp_path / "report.md").read_text(encoding="utf-8")


def test_block_is_replaced_only_where_it_differs():
    from bondlake.plans.report import replace_block

    text = "x /* m begin */ old /* m end */ y"
    new, changed = replace_block(text, "m", "new")
    assert changed and replace_block(new, "m", "new") == (new, False)
    assert replace_block(text, "other", "new") == (text, False)


def test_deep_markup_does_not_end_the_task():
    assert listing_rows("<div id='to-print1'>" + "<b>" * 20_000 + "<ul><li><a href='x'>t</a></li></ul>") == [("x", "t", "")]


def test_early_stop_is_by_source(spark):
    rows = [(s, p, f"{s}{p}", seen) for s, seen in (("a", True), ("b", False)) for p in range(1, 12)]
    x = spark.createDataFrame(rows, "source string, page_no int, url string, seen boolean")
    got = S.early_stop(x, 100, source="source").groupBy("source").agg(F.max("page_no").alias("n"))
    assert {r.source: r.n for r in got.collect()} == {"a": 6, "b": 11}
