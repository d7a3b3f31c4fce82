"""Dates, gaps and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F



def spaced(*parts: str) -> str:
    """A pattern of parts that white space may divide."""
    return r"\s*".join(parts)


def _counted(unit: str, most: int = 2, least: int = 1) -> str:
    return spaced(rf"(\d{{{least},{most}}})", unit)


def _optional(pattern: str) -> str:
    return f"(?:{pattern})?"


_YEAR, _DAY = _counted("年", 4, 4), spaced(_counted("月"), _counted("日"))
_CLOCK = r"\d{1,2}[:：]\d{2}"
#: A date with its year, and one that may lack it (groups: year, month, day; white space anywhere, digits of any script).
FULL_DATE = "(?U)" + spaced(_YEAR, _DAY)
_ANY_DATE = "(?U)" + spaced(_optional(_YEAR), _DAY)
_HOURS = spaced(_optional("[上下]午"), _CLOCK, _optional(spaced("[-~–—]", _CLOCK)), _optional("为竞争性"))
#: What has to follow a date at once for it to be that of an event.
BID = spaced(_ANY_DATE, _optional(_HOURS), "招标")
PAYMENT = spaced(_ANY_DATE, "起?", "开始计息")
LISTING = spaced(_ANY_DATE, r"起.{0,20}?上市")


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """The group of the first match, null where there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def ymd(y: Column, m: Column, d: Column) -> Column:
    """DATE of year, month and day as strings or numbers; null where that is no date."""
    slim = lambda c: F.translate(c.cast("string"), "０１２３４５６７８９", "0123456789")
    return F.try_to_date(F.concat_ws("-", slim(y), slim(m), F.coalesce(slim(d), F.lit("x"))), "yyyy-M-d")


def full_date(text: Column) -> Column:
    """The first 2026年7月2日 in the text."""
    return ymd(found(text, FULL_DATE, 1), found(text, FULL_DATE, 2), found(text, FULL_DATE, 3))


def anchored_date(text: Column, pattern: str, fallback_year: Column) -> Column:
    """The first match of a date pattern; a missing year is that of the last full date before it, else the fallback.

    Characters beyond the basic plane are dropped first, as positions count UTF-16 units.
    """
    t = F.regexp_replace(text, r"[\x{10000}-\x{10ffff}]", "")
    before = F.substring(t, F.lit(1), F.regexp_instr(t, F.lit(pattern)) - 1)
    anchor = F.try_element_at(F.regexp_extract_all(before, F.lit(FULL_DATE), F.lit(1)), F.lit(-1))
    year = F.coalesce(found(t, pattern, 1), anchor, fallback_year.cast("string"))
    hit = found(t, pattern, 2).isNotNull()
    return F.when(hit, ymd(year, found(t, pattern, 2), found(t, pattern, 3)))


def any_date(c: Column) -> Column:
    """DATE of a raw string in one of the usual notations (2026-07-01, 2026/7/1, 2026.7.1, 20260701, 2026年7月1日)."""
    t = F.trim(c)
    sep = r"^(\d{4})\s*[-/.年]\s*(\d{1,2})\s*[-/.月]\s*(\d{1,2})\s*日?(?:[ T].*)?$"
    return F.coalesce(ymd(found(t, sep, 1), found(t, sep, 2), found(t, sep, 3)), F.try_to_date(found(t, r"^\d{8}$"), "yyyyMMdd"))


def weekday_label(d: Column) -> Column:
    from bondlake.dims import WEEKDAYS

    return F.try_element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(d) + 1)


def quarter_label(d: Column) -> Column:
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def with_workday_gap(df: DataFrame, calendar: DataFrame, start: str, end: str, name: str = "workday_gap") -> DataFrame:
    """Workdays after ``start`` up to ``end``: a difference of running counts, two lookups per row.

    Null where a date is null or outside the calendar, or the end is before the start;
    0 for equal dates, which need no calendar. A calendar has a row per day, 366 a year
    at most, which bounds what the planner may send to every task.
    """
    a = calendar.select(F.col("d").alias("_a"), F.col("cum").alias("_ca"))
    b = calendar.select(F.col("d").alias("_b"), F.col("cum").alias("_cb"))
    out = df.join(F.broadcast(a), F.col(start) == F.col("_a"), "left").join(F.broadcast(b), F.col(end) == F.col("_b"), "left")
    gap = F.when(F.col(start) == F.col(end), F.lit(0)).when(F.col(end) > F.col(start), F.col("_cb") - F.col("_ca"))
    return out.withColumn(name, gap.cast("int")).drop("_a", "_ca", "_b", "_cb")


def workdays_by_formula(start: Column, end: Column, holidays: Column | None = None, makeups: Column | None = None) -> Column:
    """The same count by weekday arithmetic, less ``holidays`` and plus ``makeups`` in between: a second implementation.

    For an end before the start it counts backwards, as a spreadsheet does.
    """
    weekdays_to = lambda c: F.floor((F.unix_date(c) + 3) / 7) * 5 + F.least(F.pmod(F.unix_date(c) + 3, F.lit(7)) + 1, F.lit(5))
    n = weekdays_to(end) - weekdays_to(start)
    inside = lambda days: F.size(F.filter(days, lambda d: (d > start) & (d <= end)))
    if holidays is not None:
        n = n - inside(holidays)
    if makeups is not None:
        n = n + inside(makeups)
    return n.cast("int")


def covered_period(title: Column, text: Column) -> tuple[Column, Column, Column]:
    """(year, first month, last month) of a plan: a quarter in the title, then in the opening; then a month in either."""
    ordinals = "一二三四"
    quarter, month = "(?U)" + spaced(_YEAR + f"第?([{ordinals}1-4])", "季度"), "(?U)" + spaced(_YEAR, _counted("月"))
    slim = lambda c: F.translate(c, ordinals + "０１２３４５６７８９", "12340123456789").try_cast("int")
    places = [title, F.substring(text, 1, 200)]
    hit = lambda pattern, group: F.coalesce(*[found(p, pattern, group) for p in places])
    q, m = slim(hit(quarter, 2)), slim(hit(month, 2))
    return slim(F.coalesce(hit(quarter, 1), hit(month, 1))), F.coalesce(3 * q - 2, m), F.coalesce(3 * q, m)


def period_bounds(year: Column, first: Column, last: Column) -> tuple[Column, Column]:
    """First day of the first month and last day of the last; null where the months are none."""
    return ymd(year, first, F.lit(1)), F.last_day(ymd(year, last, F.lit(1)))
