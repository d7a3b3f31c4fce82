"""Nested payloads of the plan months and of the issuance calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bondlake.operators.stats import AMOUNTS, month_by_province, month_by_region, month_slice


def _month_label(d: Column) -> Column:
    return F.concat(F.year(d).cast("string"), F.lit("年"), F.month(d).cast("string"), F.lit("月"))


def month_payload(plans: DataFrame, dim_region: DataFrame, n_provinces: int, month_start: Column) -> DataFrame:
    """One row (label, covered, total, totalYi, asOf, provinces, regions), or none if the month has no plans."""
    sub = month_slice(plans, month_start)
    names = list(AMOUNTS.values())
    prov = month_by_province(sub).agg(
        F.count(F.lit(1)).cast("int").alias("covered"), F.round(F.sum("total"), 1).alias("totalYi"),
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("total")).alias("k"), "province", *names))), lambda x: F.struct(x["province"].alias("province"), *[x[n].alias(n) for n in names])).alias("provinces"),
    )
    region = month_by_region(sub, dim_region).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "region", *names))), lambda x: F.struct(x["region"].alias("region"), *[x[n].alias(n) for n in names])).alias("regions"))
    head = sub.agg(F.count(F.lit(1)).alias("rows"), F.date_format(F.max("pub_date"), "yyyy-MM-dd").alias("asOf")).filter("rows > 0")
    # three tables of one row each
    out = head.join(prov, F.lit(True)).join(region, F.lit(True))
    return out.select(_month_label(month_start).alias("label"), "covered", F.lit(n_provinces).alias("total"), "totalYi", F.coalesce("asOf", F.lit("")).alias("asOf"), "provinces", "regions")


def month_json(payload: DataFrame) -> DataFrame:
    return payload.select("label", F.to_json(F.struct(*payload.columns), {"ignoreNullFields": "false"}).alias("json"))


def latest_month(results: DataFrame, date_col: str = "issue_date") -> DataFrame:
    """(month_start, month_end, as_of) of the latest date."""
    top = results.agg(F.max(date_col).alias("as_of")).filter("as_of is not null")
    return top.select(F.trunc("as_of", "MM").alias("month_start"), F.last_day("as_of").alias("month_end"), "as_of")


def calendar_days(results: DataFrame, date_col: str = "issue_date") -> DataFrame:
    """(day, n, amount_yi, bonds) of the latest month; bonds by amount, largest first, nulls last, then by name.

    A day's bonds are one array, as the payload asks for: the month filter bounds it by what is issued on one day.
    """
    month = latest_month(results, date_col)
    x = results.join(F.broadcast(month), F.col(date_col).between(F.col("month_start"), F.col("month_end")))
    bond = F.struct(
        F.coalesce(-F.col("total_amount_yi"), F.lit(float("inf"))).alias("k"), F.coalesce("bond_short_name", "bond_name").alias("bondShortName"), F.col("province"), F.col("term"),
        F.round("total_amount_yi", 2).alias("amountYi"), F.round("coupon_rate_pct", 2).alias("couponPct"), F.col("result_id").alias("id"),
    )
    days = x.groupBy(F.date_format(date_col, "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.round(F.coalesce(F.sum("total_amount_yi"), F.lit(0.0)), 1).alias("amount_yi"), F.array_sort(F.collect_list(bond)).alias("_b"))
    return days.select("day", "n", "amount_yi", F.transform("_b", lambda b: F.struct(b["province"].alias("province"), b["bondShortName"].alias("bondShortName"), b["term"].alias("term"), b["amountYi"].alias("amountYi"), b["couponPct"].alias("couponPct"))).alias("bonds"))


def calendar_payload(results: DataFrame, date_col: str = "issue_date") -> DataFrame:
    """One row (monthLabel, asOf, days) with days a map from day to its bonds; none without any date."""
    days = calendar_days(results, date_col).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("day", F.struct("n", F.col("amount_yi").alias("amountYi"), "bonds"))))).alias("days"))
    month = latest_month(results, date_col)
    return month.join(days, F.lit(True)).select(_month_label(F.col("month_start")).alias("monthLabel"), F.date_format("as_of", "yyyy-MM-dd").alias("asOf"), "days")
