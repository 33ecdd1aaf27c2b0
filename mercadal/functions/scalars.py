"""Scalar column expressions. Everything stays inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mercadal.functions.exact import finite

# digits of the money columns: amounts, prices, rates of discount
MONEY_DIGITS = 6

# a plain decimal number: no type suffixes, no hexadecimal forms
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
STAMP_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def half_up(col: Column, digits: int) -> Column:
    """Half-up rounding, in one step, of a double as it is written in decimals."""
    return F.round(col.cast("double"), digits)


def decimal_total(col: Column, digits: int) -> Column:
    """Exact sum of a column of decimals of at most ``digits`` digits (money:
    2), as a decimal.

    Whole parts and scaled fractions are added up as two 64-bit integers, so the
    order in which partitions arrive does not matter. NaN counts as null; a
    number that 64 bits do not hold fails. For columns that are no such decimals
    (durations, measurements) there is ``exact.exact_sums``.
    """
    x = finite(col)
    whole = F.floor(x)
    part = F.rint((x - whole.cast("double")) * F.lit(10.0**digits)).cast("bigint")
    unit = F.lit(f"1e-{digits}").cast(f"decimal({digits},{digits})")
    total = F.sum(whole).cast("decimal(19,0)") + F.sum(part).cast("decimal(19,0)") * unit
    return total.cast(f"decimal({22 + digits},{digits})")


def money_sum(col: Column) -> Column:
    return decimal_total(col, MONEY_DIGITS).cast("double")


def money_mean(col: Column) -> Column:
    return money_sum(col) / F.nullif(F.count(finite(col)), F.lit(0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole * 100``, null when the whole is zero."""
    part, whole = part.cast("double"), whole.cast("double")
    return half_up(part * F.lit(100.0) / F.nullif(whole, F.lit(0.0)), digits)


def lenient_number(col: Column) -> Column:
    """Text to double; anything that is not a finite number becomes null."""
    number = col.try_cast("double")
    return F.when(col.cast("string").rlike(NUMBER_PATTERN) & (F.abs(number) < F.lit(float("inf"))), number)


def lenient_timestamp(col: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to a zone-free timestamp, else null."""
    return F.when(col.rlike(STAMP_PATTERN), col.try_cast("timestamp_ntz"))


def stamp_text(when: Column) -> Column:
    """Zone-free timestamp to ``yyyy-MM-dd HH:mm:ss`` text, whatever the session zone."""
    return F.substring(when.cast("string"), 1, 19)


def period_label(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year, month)


def month_key(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM")


def weekday_name(when: Column) -> Column:
    """English day name padded to nine characters."""
    return F.rpad(F.date_format(when, "EEEE"), 9, " ")


def weekday_number(when: Column) -> Column:
    """Sunday = 0 .. Saturday = 6."""
    return F.dayofweek(when) - F.lit(1)


def base_name(path: Column) -> Column:
    """Last path segment; both slash styles occur in old lineage files."""
    return F.element_at(F.split(path, r"[/\\]"), -1)


def whole_seconds(stamp: Column) -> Column:
    """ISO text stamp cut to whole seconds."""
    return F.substring(stamp, 1, 19)


def labelled_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the zero-padded number; wider numbers are kept whole."""
    number = number.cast("bigint")
    digits = number.cast("string")
    padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))
    # nulls and signs are left to the formatter, which takes several times as long
    rest = F.format_string(f"{prefix}%0{width}d", number)
    return F.when(number >= 0, F.concat(F.lit(prefix), padded)).otherwise(rest)


def cents(col: Column) -> Column:
    return half_up(col, 2)


def thousands(col: Column) -> Column:
    return col / F.lit(1000.0)


def normalised(weight: Column, total: Column) -> Column:
    return weight.cast("double") / F.nullif(total.cast("double"), F.lit(0.0))


def utc_now_text() -> Column:
    """ISO-8601 text of the current instant in UTC."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def stamp_literal(stamp) -> Column:
    """A Python datetime (or ISO text) as a zone-free timestamp literal."""
    return F.lit(str(stamp)).cast("timestamp_ntz")
