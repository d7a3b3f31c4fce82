"""Chinese and Arabic numerals as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_DIGITS = "零一二三四五六七八九"


def spell(n: int) -> str:
    """Chinese spelling of 0..999."""
    if n < 10:
        return _DIGITS[n]
    if n < 100:
        tens, ones = divmod(n, 10)
        return ("" if tens == 1 else _DIGITS[tens]) + "十" + (_DIGITS[ones] if ones else "")
    hundreds, rest = divmod(n, 100)
    if not rest:
        return _DIGITS[hundreds] + "百"
    if rest < 10:
        return _DIGITS[hundreds] + "百零" + _DIGITS[rest]
    return _DIGITS[hundreds] + "百" + ("一" if rest < 20 else "") + spell(rest)


#: One to nine, and what is written for them and for nothing.
_ONES = _DIGITS[1:]
_SPOKEN = rf"(?:[{_ONES}]百(?:零[{_ONES}]|[{_ONES}]?十[{_ONES}]?)?|[{_ONES}]?十[{_ONES}]?|[零{_ONES}])"
SIGNS = rf"[{_ONES}零〇两俩十百0-9０-９]+"


def bound(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _spoken(t: Column) -> Column:
    """The value of a well-formed spelling: what stands before 百, before 十, and last."""
    digit = lambda x: F.when(F.length(x) > 0, F.position(x, F.lit(_ONES))).otherwise(0)

    def below(x: Column) -> Column:
        return F.when(F.contains(x, F.lit("十")), F.greatest(F.lit(1), digit(F.substring_index(x, "十", 1))) * 10 + digit(F.substring_index(x, "十", -1))).otherwise(digit(F.ltrim(x, F.lit("零"))))

    hundreds = F.when(F.contains(t, F.lit("百")), 100 * digit(F.substring_index(t, "百", 1))).otherwise(0)
    return (hundreds + bound(F.substring_index(t, "百", -1), below)).cast("int")


def numeral(c: Column) -> Column:
    """INT of a Chinese (0 to 999) or Arabic numeral, else null; surrounding space is ignored."""
    plain = F.trim(F.translate(c, "０１２３４５６７８９〇两俩　\t\n\r", "0123456789零二二    "))
    return bound(plain, lambda t: F.when(t.rlike("^[0-9]+$"), t.try_cast("int")).when(t.rlike(f"^{_SPOKEN}$"), _spoken(t)))


def issue_range(c: Column) -> Column:
    """ARRAY<INT> of the issues that a label names: one number, or all from the first to the last.

    A falling range keeps its two ends, parts that are no number are left out, and a label
    without any number (or no label) gives an empty array.
    """
    numbers = F.filter(F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({SIGNS})"), F.lit(1)), numeral), lambda n: n.isNotNull())

    def span(read: Column) -> Column:
        first, last = F.try_element_at(read, F.lit(1)), F.try_element_at(read, F.lit(-1))
        return F.when((F.size(read) > 1) & (last > first), F.sequence(first, F.greatest(first, last))).when(F.size(read) > 1, F.array(first, last)).otherwise(read)

    return bound(numbers, span)
