"""Fixed vocabularies and dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

# Provinces and cities with their own plan, in listed order, with codes.
PROVINCES = {
    "北京市": "11", "天津市": "12", "河北省": "13", "山西省": "14", "内蒙古自治区": "15", "辽宁省": "21", "大连市": "2102", "吉林省": "22", "黑龙江省": "23", "上海市": "31",
    "江苏省": "32", "浙江省": "33", "宁波市": "3302", "安徽省": "34", "福建省": "35", "厦门市": "3502", "江西省": "36", "山东省": "37", "青岛市": "3702", "河南省": "41",
    "湖北省": "42", "湖南省": "43", "广东省": "44", "深圳市": "4403", "广西壮族自治区": "45", "海南省": "46", "重庆市": "50", "四川省": "51", "贵州省": "52", "云南省": "53",
    "西藏自治区": "54", "陕西省": "61", "甘肃省": "62", "青海省": "63", "宁夏回族自治区": "64", "新疆维吾尔自治区": "65", "新疆生产建设兵团": "66",
}
# Terms in order, weekdays from Monday, category labels.
TERMS = ["1Y", "2Y", "3Y", "5Y", "7Y", "10Y", "15Y", "20Y", "25Y", "30Y"]
WEEKDAYS = ["周一", "周二", "周三", "周四", "周五", "周六", "周日"]
CATEGORY_LABELS = {"new_general": "一般新增债券", "new_special": "专项新增债券", "refinancing": "再融资债券"}
# The channels of the site: name, label, channel id, document type, path.
CHANNELS = [
    ("dfzfxjh", "发行安排（月度/季度发行计划）", "192", "plan", "/dfzfxjh/"),
    ("fxqgg", "发行前公告（单期正式发行公告）", "193", "announcement", "/fxqgg/"),
    ("fxjg", "发行结果（含债券编码/简称的发行结果公开）", "194", "result", "/fxjg/"),
]
#: Least lead in workdays, high outlier above, largest believable gap in days.
FLOOR_WORKDAYS, HIGH_WORKDAYS, MAX_GAP_DAYS = 5, 30, 400

#: Names longest first; equal lengths keep the listed order.
PROVINCE_SEARCH = sorted(PROVINCES, key=len, reverse=True)


def calendar(spark: SparkSession, start: date, end: date, holidays: list[date] = (), makeups: list[date] = ()) -> DataFrame:
    """(d, is_workday, cum): weekdays without ``holidays``, and weekend ``makeups``; cum counts workdays up to d."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("d"))
    off = F.col("d").isin(list(holidays)) if holidays else F.lit(False)
    on = F.col("d").isin(list(makeups)) if makeups else F.lit(False)
    days = days.withColumn("is_workday", ((F.weekday("d") < 5) & ~off) | on)
    # one row a day: a century is 36,525 rows, so one task sorts them
    return days.withColumn("cum", F.sum(F.col("is_workday").cast("int")).over(W.orderBy("d").rowsBetween(W.unboundedPreceding, 0)).cast("int"))


def channels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHANNELS, "name string, label string, channel_id string, doc_type string, detail_prefix string")
