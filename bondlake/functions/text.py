"""Classification, numbers and formats read from text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from bondlake.dims import CATEGORY_LABELS, PROVINCE_SEARCH, PROVINCES
from bondlake.functions.dates import found, spaced

#: A number in digits with thousands signs.
AMOUNT = r"\d[\d,]*(?:\.\d*)?"


def first_contained(text: Column, names: list[str]) -> Column:
    """The first of ``names``, in the order given, that the text contains; null for none or no text."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(n)), F.lit(n)) for n in names])


def province(title: Column, text: Column) -> Column:
    """The province named in the title, else in the opening of the text."""
    return F.coalesce(first_contained(title, PROVINCE_SEARCH), first_contained(F.substring(text, 1, 2000), PROVINCE_SEARCH))


def lookup(c: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)


def province_code(name: Column) -> Column:
    return lookup(name, PROVINCES)


def category(name: Column) -> Column:
    """refinancing before new_special before new_general, by the words of the name."""
    return F.when(F.contains(name, F.lit("再融资")), "refinancing").when(F.contains(name, F.lit("专项")), "new_special").when(F.contains(name, F.lit("一般")), "new_general")


def category_subtype(name: Column) -> Column:
    kind = F.when(F.contains(name, F.lit("专项")), "专项").when(F.contains(name, F.lit("一般")), "一般")
    return F.when(F.contains(name, F.lit("再融资")), kind)


def category_label(code: Column) -> Column:
    return lookup(code, CATEGORY_LABELS)


def category_of_amounts(refi: Column, new: Column, swap: Column, market_type: Column) -> Column:
    special = F.coalesce(F.contains(market_type, F.lit("专项")), F.lit(False))
    return F.when(refi > 0, "refinancing").when((new > 0) & special, "new_special").when(new > 0, "new_general").when(swap > 0, "refinancing")


def half_width(c: Column) -> Column:
    return F.translate(c, "０１２３４５６７８９", "0123456789")


def term_bucket(text: Column) -> Column:
    """10Y of 10年期: the first number of one or two digits before 年."""
    return F.concat(half_width(found(text, "(?U)" + spaced(r"(\d{1,2})", "年"), 1)).try_cast("int").cast("string"), F.lit("Y"))


def first_amount(cell: Column) -> Column:
    return F.regexp_replace(found(cell, AMOUNT), ",", "").try_cast("double")


def robust_float(c: Column) -> Column:
    """DOUBLE of a cell, without commas and any white space, else of the first number in it."""
    t = F.regexp_replace(half_width(c), r"(?U)[,\s]+", "")
    return F.coalesce(t.try_cast("double"), found(t, r"[\d.]+").try_cast("double"))


def labelled_amount(text: Column) -> Column:
    """The total of a batch: the planned total, else the total, else the tender volume."""
    named = [found(text, "(?U)" + spaced(label, f"({AMOUNT})", "亿元"), 1) for label in ("计划发行总额", "发行总额", "招标总量")]
    return F.regexp_replace(F.coalesce(*named), ",", "").try_cast("double")


def document_number(text: Column) -> Column:
    """The first document number, with the two to eight characters that stand before its year."""
    return found(text, "(?U)" + spaced(r"\p{IsHan}{2,8}〔\d{4}〕\d+", "号"))


def issue_label(name: Column) -> Column:
    """The first bracket of up to 13 characters that ends in 期."""
    brackets = F.regexp_extract_all(name, F.lit(r"[(（]([^()（）]+期)[)）]"), F.lit(1))
    return F.try_element_at(F.filter(brackets, lambda b: F.length(b) <= 13), F.lit(1))


def plan_numbers(text: Column, header: str) -> Column:
    """The numbers of the line below a block header, without its leading period label; null without the block."""
    line = found(text, header + r"\s*\n(.+)", 1)
    amounts = F.regexp_replace(line, r"^[\s\p{Nd}第一二三四]{1,8}(?:月|季度)", "")
    return F.when(line.isNotNull(), F.transform(F.regexp_extract_all(amounts, F.lit(f"({AMOUNT})"), F.lit(1)), lambda x: F.regexp_replace(x, ",", "").try_cast("double")))


#: Headers of the two blocks of a plan.
REFINANCING_BLOCK, NEW_BLOCK = "(?U)" + spaced("时间", "再融资债券计划发行规模"), "(?U)" + spaced("时间", "新增一般债券", "新增专项债券")


def warnings(*conditions: tuple[Column, Column | str]) -> Column:
    """The messages whose condition holds, joined; empty if none."""
    return F.concat_ws("; ", *[F.when(c, m if isinstance(m, Column) else F.lit(m)) for c, m in conditions])


def half_even(x: Column, digits: int) -> Column:
    """Scale, round half to even, unscale."""
    return F.rint(x * 10**digits) / 10**digits


def shown(x: Column, digits: int = 1) -> Column:
    """A number for a report, N/A for null."""
    return F.when(x.isNotNull() & ~F.isnan(x.cast("double")), F.format_string(f"%.{digits}f", half_even(x.cast("double"), digits))).otherwise("N/A")


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)
