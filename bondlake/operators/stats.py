"""Statistics over the state tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bondlake.dims import FLOOR_WORKDAYS, HIGH_WORKDAYS
from bondlake.functions.text import half_even


def lead_stats(natural: str = "natural_day_gap", workdays: str = "workday_gap") -> list[Column]:
    """n counts all rows; mean to two digits, exact median, max and min of either gap, null where there is no value."""
    out = [F.count(F.lit(1)).alias("n")]
    for c, name in ((natural, "natural"), (workdays, "workday")):
        out += [half_even(F.avg(c), 2).alias(f"{name}_mean"), F.median(c).alias(f"{name}_median"), F.max(c).alias(f"{name}_max"), F.min(c).alias(f"{name}_min")]
    return out


def lead_by(df: DataFrame, *keys: str) -> DataFrame:
    """lead_stats per group; rows with a null key are in no group."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*lead_stats())


def with_share(df: DataFrame, count: str = "n", name: str = "share_pct") -> DataFrame:
    """Per cent of the total of an already grouped (small) table; 0 where the total is 0."""
    return df.withColumn(name, F.round(F.coalesce(F.try_divide(100.0 * F.col(count), F.sum(count).over(W.partitionBy())), F.lit(0.0)), 4))


def low_anomalies(df: DataFrame) -> DataFrame:
    return df.filter(F.col("workday_gap") < FLOOR_WORKDAYS)


def high_outliers(df: DataFrame) -> DataFrame:
    return df.filter(F.col("workday_gap") > HIGH_WORKDAYS)


def anomaly_rate(df: DataFrame) -> DataFrame:
    """Anomalies of all rows against rows with a category, in one pass."""
    low, valid = F.count_if(F.col("workday_gap") < FLOOR_WORKDAYS), F.count("category_code")
    return df.agg(low.alias("anomalies"), valid.alias("valid_rows"), F.round(100.0 * low / F.greatest(valid, F.lit(1)), 4).alias("rate_pct"))


def mode_of(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value and its number; of equals the smallest value."""
    return df.dropna(subset=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(1)


def skewed_quarters(by_quarter: DataFrame, above: float = 3.0, least: int = 4) -> DataFrame:
    """Quarters whose mean exceeds the median by more than ``above``; none if there are fewer than ``least`` quarters."""
    counted = by_quarter.withColumn("_quarters", F.count(F.lit(1)).over(W.partitionBy()))
    return counted.filter((F.col("_quarters") >= least) & (F.col("workday_mean") - F.col("workday_median") > above)).drop("_quarters")


def boxplot(df: DataFrame, value: str, key: str) -> DataFrame:
    """Quartiles, whiskers (the extreme values within 1.5 interquartile ranges) and the number of fliers per key."""
    x = df.dropna(subset=[value, key])
    box = x.groupBy(key).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"), F.count(F.lit(1)).alias("n"))
    box = box.select(key, "n", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    # the box table has a row per key; the planner sends it to the tasks if it is small
    far = x.select(key, value).join(box, key).groupBy(key).agg(F.min(F.when(inside, F.col(value))).alias("whisker_low"), F.max(F.when(inside, F.col(value))).alias("whisker_high"), F.count_if(~inside).alias("fliers"))
    return box.join(far, key)


def months_between(start: Column, end: Column) -> Column:
    return F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))


def range_join(plans: DataFrame, anns: DataFrame) -> DataFrame:
    """Plan rows with the announcements of their province that bid within the covered period.

    A range join as an equality join: each plan is expanded to its (few) months, both sides
    meet on province and month, and the exact bounds are a remaining condition. Neither side
    is sent whole to the tasks, and a province's months spread over them.
    """
    p = plans.filter("covered_period_start is not null and covered_period_end >= covered_period_start and province is not null").withColumn("_month", F.explode(months_between(F.col("covered_period_start"), F.col("covered_period_end")))).alias("p")
    a = anns.filter("bid_date is not null and province is not null").withColumn("_month", F.trunc("bid_date", "MM")).alias("a")
    on = (F.col("p.province") == F.col("a.province")) & (F.col("p._month") == F.col("a._month")) & F.col("a.bid_date").between(F.col("p.covered_period_start"), F.col("p.covered_period_end"))
    return p.join(a, on)


def plan_lead(plans: DataFrame, anns: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per plan with matches: number, and least, greatest and mean lead of the plan before the bids."""
    from bondlake.functions.dates import with_workday_gap

    x = range_join(plans.filter("pub_date is not null"), anns).select("p.plan_id", "p.province", F.col("p.pub_date").alias("plan_pub_date"), F.col("a.bid_date").alias("bid_date"))
    x = with_workday_gap(x.withColumn("_days", F.datediff("bid_date", "plan_pub_date")), calendar, "plan_pub_date", "bid_date", "_work")
    return x.groupBy("plan_id", "province", "plan_pub_date").agg(
        F.count(F.lit(1)).alias("n"), F.min("_days").alias("natural_min"), F.max("_days").alias("natural_max"), half_even(F.avg("_days"), 1).alias("natural_mean"),
        F.min("_work").alias("workday_min"), F.max("_work").alias("workday_max"), half_even(F.avg("_work"), 1).alias("workday_mean"),
    )


AMOUNTS = {"plan_general_amount_yi": "general", "plan_special_amount_yi": "special", "plan_refinancing_amount_yi": "refi"}


def month_slice(plans: DataFrame, month_start: Column) -> DataFrame:
    """Plans whose period starts in the month; a quarter counts whole in its first month."""
    return plans.filter(F.col("covered_period_start") == month_start)


def current_and_next(plans: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """The slices of the month of ``as_of`` and of the following one."""
    month = F.trunc(as_of, "MM")
    return {"current": month_slice(plans, month), "next": month_slice(plans, F.add_months(month, 1))}


def month_by_province(plans: DataFrame) -> DataFrame:
    sums = [F.sum(F.coalesce(F.col(c), F.lit(0.0))).alias(n) for c, n in AMOUNTS.items()]
    out = plans.dropna(subset=["province"]).groupBy("province").agg(*sums)
    return out.select("province", *[F.round(n, 2).alias(n) for n in AMOUNTS.values()], F.round(F.col("general") + F.col("special") + F.col("refi"), 2).alias("total"))


def month_by_region(plans: DataFrame, dim_region: DataFrame) -> DataFrame:
    """A row for every region in its order, zero where it has no plans."""
    per = plans.join(dim_region.select("province", "region"), "province").groupBy("region").agg(*[F.sum(F.coalesce(F.col(c), F.lit(0.0))).alias(n) for c, n in AMOUNTS.items()])
    out = dim_region.select("region", "ord").distinct().join(per, "region", "left")
    return out.select("region", "ord", *[F.round(F.coalesce(F.col(n), F.lit(0.0)), 2).alias(n) for n in AMOUNTS.values()])
