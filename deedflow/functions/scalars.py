"""Column functions: coercion, text, dates, ratios, flags and rounding."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from deedflow.fields import NA_TOKENS

# Decimal text only: `try_cast` alone would accept Java suffixes such as "1d".
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# `try_cast` alone would accept a bare year or year-month.
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}"
# Every character that counts as whitespace in Unicode text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")
# Formats of dates, for all fields or by field.
Formats = Sequence[str] | Mapping[str, Sequence[str]]


def ref(name: str) -> Column:
    """Column by exact name, also when the name holds a dot."""
    return F.col("`" + name.replace("`", "``") + "`")


def any_of(flags: Iterable[Column]) -> Column:
    """OR of flags; false when there are none."""
    return reduce(or_, flags, F.lit(False))


def is_true(condition: Column) -> Column:
    """The condition with NULL read as false."""
    return F.coalesce(condition, F.lit(False))


def na_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TOKENS), text)


def text_to_double(text: Column) -> Column:
    number = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def to_double(df: DataFrame, name: str) -> Column:
    """Field as double: bad text and NaN become NULL."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return text_to_double(ref(name))
    value = ref(name).cast("double")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.nanvl(value, F.lit(None))
    return value


def text_to_timestamp(text: Column, formats: Iterable[str] = ()) -> Column:
    """Timestamp without zone from ISO text, or else from the given formats.

    Each row is parsed by itself, so a column may mix formats.
    """
    iso = F.when(text.rlike(ISO_DATE_PATTERN), text.try_cast("timestamp_ntz"))
    others = [
        F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in formats
    ]
    return F.coalesce(iso, *others)


def to_timestamp(df: DataFrame, name: str, formats: Formats = ()) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        if isinstance(formats, Mapping):
            formats = formats.get(name, ())
        return text_to_timestamp(ref(name), formats)
    return ref(name).cast("timestamp_ntz")


def to_date(df: DataFrame, name: str, formats: Formats = ()) -> Column:
    if isinstance(df.schema[name].dataType, T.DateType):
        return ref(name)
    return to_timestamp(df, name, formats).cast("date")


def year_month(date: Column) -> Column:
    """yyyy-MM text, free of the session time zone."""
    return F.substring(date.cast("date").cast("string"), 1, 7)


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def month_token(path: Column) -> Column:
    """The six digits before the extension of a monthly file, or NULL."""
    return F.nullif(
        F.regexp_extract(path, r"(\d{6})(_[A-Za-z]+)?\.csv$", 1), F.lit("")
    )


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def strip_text(text: Column) -> Column:
    """Text without outer whitespace of any kind; empty text is NULL."""
    return F.nullif(strip(text), F.lit(""))


def postal_code(text: Column) -> Column:
    """First five digits in a row, or the stripped text where there are none."""
    cleaned = F.regexp_replace(strip_text(text), r"\.0$", "")
    return F.coalesce(F.regexp_substr(cleaned, F.lit(r"\d{5}")), cleaned)


def flag_word(text: Column) -> Column:
    return F.lower(strip(text.cast("string")))


def parse_flag(text: Column) -> Column:
    """true/1/yes in any case as true; all else, NULL included, as false."""
    return is_true(flag_word(text).isin(*TRUE_WORDS))


def to_flag(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return is_true(ref(name))
    return parse_flag(ref(name))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient where the denominator is positive, else NULL.

    Each operand stands once, so that filters on ratios stay small when the
    optimizer pushes them below the projections that compute the operands.
    """
    return F.try_divide(numerator, F.greatest(denominator, F.lit(0.0)))


def percent(part: Column, whole: Column) -> Column:
    """Percentage; 0 for an empty whole."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def equal_as_numbers_or_text(left: Column, right: Column) -> Column:
    """Equal text, or numbers within 1e-8 + 1e-5 * |right|; NULL never agrees."""
    a, b = text_to_double(left.cast("string")), text_to_double(right.cast("string"))
    close = F.abs(a - b) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(b)
    same = left.cast("string") == right.cast("string")
    return is_true(same) | is_true(close)


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < float("inf"))


def is_year_month(text: Column) -> Column:
    return text.rlike(r"^\d{4}-\d{2}$")


def rounded(value: Column | str, digits: int) -> Column:
    """Half-even rounding of the scaled double, the rule of numeric arrays.

    `bround` rounds the shortest decimal text instead and differs on values
    such as 1.015. Text is taken as an SQL expression.
    """
    scale = float(10**digits)
    if isinstance(value, str):
        return F.expr(f"rint(({value}) * {scale}D) / {scale}D")
    return F.rint(value * scale) / scale
