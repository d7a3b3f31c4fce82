"""The deliverable tables: raw data with cross-checked gaps, summaries, bond dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bondlake.functions import dates as D
from bondlake.operators import stats as A


def derived(anns: DataFrame, dim_region: DataFrame) -> DataFrame:
    region = dim_region.select("province", "region", F.col("ord").alias("region_ord"))
    return anns.join(region, "province", "left").withColumns({"weekday": D.weekday_label(F.col("bid_date")), "weekday_ord": F.weekday("bid_date"), "quarter": D.quarter_label(F.col("bid_date"))})


def summary_tables(anns: DataFrame, plans: DataFrame, dim_region: DataFrame, dim_term: DataFrame, calendar: DataFrame) -> dict[str, DataFrame]:
    """Every summary table by name, in its display order; all of them lazy."""
    x = derived(anns, dim_region)
    valid = x.filter("category_code is not null")
    order = dim_term.select("term", F.col("ord").alias("term_ord"))
    return {
        "by_category_term": A.lead_by(valid, "category_label", "term").join(order, "term").orderBy("category_label", "term_ord").drop("term_ord"),
        "by_category": A.lead_by(valid, "category_label").orderBy("category_label"),
        "by_province": A.lead_by(valid, "province").orderBy(F.desc("n"), "province"),
        "by_province_category": A.lead_by(valid, "province", "category_label").orderBy("province", "category_label"),
        "by_region": A.lead_by(valid, "region", "region_ord").orderBy("region_ord").drop("region_ord"),
        "by_region_category": A.lead_by(valid, "region", "category_label").orderBy("region", "category_label"),
        "by_weekday": A.with_share(A.lead_by(valid, "weekday", "weekday_ord")).orderBy("weekday_ord").drop("weekday_ord"),
        "by_quarter": A.lead_by(valid, "quarter").orderBy("quarter"),
        "anomalies": A.low_anomalies(x).orderBy("workday_gap", "url", "ann_id"),
        "plan_lead": A.plan_lead(plans, anns, calendar).orderBy("plan_id"),
        "boxplot": A.boxplot(valid, "workday_gap", "term").join(order, "term").orderBy("term_ord").drop("term_ord"),
    }


def raw_tables(anns: DataFrame, plans: DataFrame, results: DataFrame, dim_region: DataFrame, calendar: DataFrame) -> dict[str, DataFrame]:
    """Every row with its derived columns: announcements with both workday counts, plans, the bond dictionary and what has no code."""
    coded, legacy = bond_dictionary(results)
    holidays = calendar.filter((F.weekday("d") < 5) != F.col("is_workday")).select("d", "is_workday").orderBy("d")
    detail = derived(anns, dim_region).drop("weekday_ord", "region_ord").join(formula_check(anns, calendar).select("ann_id", "by_formula", "gap_match"), "ann_id")
    return {"detail": detail, "plans": plans.orderBy("covered_period_start", "plan_id"), "bond_dictionary": coded, "legacy_results": legacy, "holidays": holidays, "formula_check": formula_check(anns, calendar)}


def formula_check(anns: DataFrame, calendar: DataFrame) -> DataFrame:
    """Both workday counts side by side; they agree wherever the bid isn't before the publication and the calendar has no holidays."""
    x = D.with_workday_gap(anns.select("ann_id", "pub_date", "bid_date"), calendar, "pub_date", "bid_date", "by_calendar")
    x = x.withColumn("by_formula", D.workdays_by_formula(F.col("pub_date"), F.col("bid_date")))
    return x.withColumn("gap_match", F.col("by_calendar").eqNullSafe(F.col("by_formula")))


def bond_dictionary(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a code, rows of the old format)."""
    return results.filter("bond_code is not null"), results.filter("extraction_method = 'unsupported_legacy_format'")
