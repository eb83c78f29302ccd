"""Column functions over meeting text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the input format: how a speaker turn is labelled, and full-width digits and colon.
SPEAKER = "发言人"
FULL_WIDTH_DIGITS, DIGITS = "０１２３４５６７８９", "0123456789"
#: Chinese digits and the year sign; units that may stand behind a number, a longer one before its beginning.
HAN_DIGITS, YEAR = "〇一二三四五六七八九", "年"
UNITS = "个百分点|个基点|个点|百分点|基点|％|%|‰|亿美元|万美元|美元|亿元|万元|千元|元|亿|万|倍|套|台|吨|家|股|个月|年|月|天"
LABEL = SPEAKER + r"[0-9０-９]+[：:]"
#: What separates parts in text; Spark's trim takes spaces only, so the ideographic space is named.
BLANKS = " \t\n\r　"


def stripped(text: Column) -> Column:
    """Text without white space around it, the ideographic space included."""
    return F.btrim(text, F.lit(BLANKS))


def plain_digits(text: Column) -> Column:
    """Full-width digits as ASCII."""
    return F.translate(text, FULL_WIDTH_DIGITS, DIGITS)


def number_tokens(text: Column) -> Column:
    """The numbers of a text as written (digits with decimal point and per cent sign); never parsed, for units may be unclear."""
    return F.regexp_extract_all(plain_digits(F.coalesce(text, F.lit(""))), F.lit(r"[0-9]+(?:\.[0-9]+)?%?"), F.lit(0))


def quantities(text: Column) -> Column:
    """The numbers of a text with the unit that stands directly behind each, as written."""
    return F.regexp_extract_all(plain_digits(F.coalesce(text, F.lit(""))), F.lit(rf"[0-9]+(?:\.[0-9]+)?(?:{UNITS})?"), F.lit(0))


def added_numbers(source: Column, edited: Column) -> Column:
    """Numbers of the edited text that its source does not have, sorted."""
    return F.array_sort(F.array_except(number_tokens(edited), number_tokens(source)))


def has_han(text: Column) -> Column:
    """Whether a text has a Han character."""
    return F.coalesce(text.rlike(r"\p{IsHan}"), F.lit(False))


def masked(text: Column, phrases: Column) -> Column:
    """The text with each of the phrases (longest first) taken out, so that what is left can be searched for others."""
    longest_first = F.array_sort(phrases, lambda a, b: F.length(b) - F.length(a))
    return F.aggregate(longest_first, text, lambda left, p: F.when(F.length(p) > 0, F.replace(left, p, F.lit("\x01"))).otherwise(left))


def all_present(text: Column, phrases: Column) -> Column:
    return F.forall(phrases, lambda p: F.contains(text, p))


def missing(text: Column, phrases: Column) -> Column:
    """The phrases that a text does not contain."""
    return F.filter(F.coalesce(phrases, F.array().cast("array<string>")), lambda p: ~F.contains(text, p))


def present(text: Column, phrases: Column) -> Column:
    """The phrases that a text contains."""
    return F.filter(F.coalesce(phrases, F.array().cast("array<string>")), lambda p: F.contains(text, p))
