"""Column helpers for warehouse semantics that differ from Spark's built-ins.

Every helper is a plain Column expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters after which title-casing starts a new word, besides a space.
TITLE_DELIMITERS = '!?@"^#$&~_,.:;+-*%/|\\[](){}<>\t\n\r\f\x0b'

# Spellings a string may use for a boolean.
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")

_MARK = "\u0001 "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any_null(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def least_or_null(*cols: Column | str) -> Column:
    """Smallest argument, or NULL as soon as one argument is NULL."""
    cs = [_col(c) for c in cols]
    return F.when(~_any_null(cs), F.least(*cs))


def greatest_or_null(*cols: Column | str) -> Column:
    """Largest argument, or NULL as soon as one argument is NULL."""
    cs = [_col(c) for c in cols]
    return F.when(~_any_null(cs), F.greatest(*cs))


def date_diff_boundary(part: str, start: Column | str, end: Column | str) -> Column:
    """Number of calendar boundaries crossed between two dates or timestamps."""
    a, b = _col(start), _col(end)
    if part == "year":
        return F.year(b) - F.year(a)
    if part == "month":
        return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    if part == "day":
        return F.datediff(b, a)
    if part == "minute":
        minutes = F.timestamp_diff("MINUTE", F.date_trunc("minute", a), F.date_trunc("minute", b))
        return minutes.cast("int")
    raise ValueError(f"unsupported date part: {part}")


def title_case(c: Column | str) -> Column:
    """Capitalise words that start after a space or one of TITLE_DELIMITERS.

    Spark's ``initcap`` knows the space only, so a marked space is put after each
    delimiter before it and taken out again after it.
    """
    klass = "".join("\\" + ch if ch in "\\[]^-&~" else ch for ch in TITLE_DELIMITERS)
    spaced = F.regexp_replace(_col(c), f"([{klass}])", "$1" + _MARK)
    return F.replace(F.initcap(spaced), F.lit(_MARK), F.lit(""))


def clean_title(c: Column | str) -> Column:
    return title_case(F.trim(_col(c)))


def clean_upper(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def clean_lower(c: Column | str) -> Column:
    return F.lower(F.trim(_col(c)))


def to_int(c: Column | str) -> Column:
    """Numeric to integer, rounding half away from zero instead of truncating."""
    return F.round(_col(c)).cast("int")


def money(c: Column | str) -> Column:
    return _col(c).cast("decimal(18,2)")


def try_money(c: Column | str) -> Column:
    return _col(c).try_cast("decimal(18,2)")


def try_date(c: Column | str) -> Column:
    return _col(c).cast("string").try_cast("date")


def try_boolean(c: Column | str) -> Column:
    """String to boolean over the spellings above; anything else is NULL."""
    s = F.lower(F.trim(_col(c).cast("string")))
    return F.when(s.isin(*TRUE_WORDS), F.lit(True)).when(s.isin(*FALSE_WORDS), F.lit(False))


def try_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def _on_epoch_day(c: Column | str) -> Column:
    return F.concat(F.lit("1970-01-01 "), F.trim(_col(c).cast("string"))).try_cast("timestamp")


def try_time(c: Column | str) -> Column:
    """Time of day as ``HH:mm:ss`` text (Spark has no default TIME column type)."""
    return F.date_format(_on_epoch_day(c), "HH:mm:ss")


def try_hour(c: Column | str) -> Column:
    return F.hour(_on_epoch_day(c))


def timestamp_from_parts(date: Column | str, time: Column | str) -> Column:
    """Date plus ``HH:mm:ss`` text; NULL if either part is."""
    return F.concat(_col(date).cast("string"), F.lit(" "), _col(time)).try_cast("timestamp")


def number_label(c: Column | str) -> Column:
    """Number as text without trailing zeros: 10.0 gives 10, 12.50 gives 12.5."""
    text = _col(c).cast("decimal(18,2)").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "")


def safe_ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """Rounded quotient that is NULL, not an error, for a zero denominator.

    Operands of this size leave the quotient 14 decimals. Spark would cut that of two
    38-digit sums to 6, and rounding that again can turn 0.00499999 into 0.01.
    """
    top, bottom = numerator.cast("decimal(24,6)"), denominator.cast("decimal(24,6)")
    return F.round(top / F.nullif(bottom, F.lit(0)), scale)


def decimal_ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """The same for doubles, back as a double: exact halves round up."""
    return safe_ratio(numerator, denominator, scale).cast("double")


def percent(part: Column, whole: Column) -> Column:
    return safe_ratio(part * F.lit(100), whole)


def sum_if(condition: Column, value: Column | str) -> Column:
    """Conditional sum that is 0, not NULL, for a group without matches."""
    return F.sum(F.when(condition, _col(value)).otherwise(0))


def count_if_true(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def surrogate_key(c: Column | str) -> Column:
    """Non-negative 63-bit hash key. A NULL id gets a key of its own, not NULL."""
    return F.xxhash64(_col(c)).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
