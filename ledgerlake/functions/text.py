"""Text cleaning, tolerant parsing and identity-number checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# The patterns that decide which raw texts count as numbers, dates and CPFs.
SIGNED_NUMBER = r"^-?[0-9]+\.?[0-9]*$"
UNSIGNED_NUMBER = r"^[0-9]+\.?[0-9]*$"
ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"
CPF_FORMAT = r"^\d{3}\.\d{3}\.\d{3}-\d{2}$"

# Spellings of "no value" in published series, and of TRUE.
EMPTY_MARKERS = ("-", "", "null")
COUNT_MARKERS = ("-", "...", "X", "")
TRUE_WORDS = ("true", "1", "t")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def numeric_text(value: Column | str, signed: bool = True) -> Column:
    """TRUE for plain decimal text; exponents, plus signs and blanks are refused."""
    return _col(value).rlike(SIGNED_NUMBER if signed else UNSIGNED_NUMBER)


def to_decimal(value: Column | str, precision: int = 14, scale: int = 2) -> Column:
    """Decimal or NULL, rounded half away from zero."""
    return _col(value).try_cast(DecimalType(precision, scale))


def strict_decimal(
    value: Column | str, precision: int = 14, scale: int = 2, signed: bool = True
) -> Column:
    """Decimal only for text that `numeric_text` accepts.

    The pattern guards the cast inside one expression. A filter beside a cast
    does not: the optimizer is free to evaluate the cast first.
    """
    return F.when(numeric_text(value, signed), to_decimal(value, precision, scale))


def amount_pattern(signed: bool = True, zero: bool = True, whole: int = 12) -> str:
    """Plain decimal text that a column of two decimals and `whole` digits before them can hold once it is rounded.

    Without `zero`, an amount must not be zero at ten decimals. One match tells all that cleaning asks of an amount, so that it
    is parsed once, and only where it is kept.
    """
    sign = "-?" if signed else ""
    some = "" if zero else r"(?=[0-9]*[1-9]|[0-9]*\.[0-9]{0,9}[1-9]|[0-9]*\.[0-9]{10}[5-9])"
    fits = rf"(?!0*9{{{whole}}}\.99[5-9])"
    return rf"^{sign}{some}{fits}0*[0-9]{{1,{whole}}}(\.[0-9]*)?$"


def to_whole(value: Column | str, kind: str = "bigint") -> Column:
    return _col(value).try_cast(kind)


def to_day(value: Column | str) -> Column:
    return _col(value).try_cast("date")


def to_instant(value: Column | str) -> Column:
    """Timestamp without zone, or NULL."""
    return _col(value).try_cast("timestamp_ntz")


def mixed_instant(
    value: Column | str,
    layouts: tuple[str, ...] = ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy", "yyyyMMdd"),
) -> Column:
    """UTC wall-clock time from text in several layouts, or NULL.

    ISO text may carry an offset or a zone name, which is moved to UTC; text
    without one is taken to be UTC already.
    """
    text = F.trim(_col(value))
    zoned = text.rlike(r"\d{2}:\d{2}.*(Z|UTC|GMT|[+-]\d{2}:?\d{2})$")
    moved = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz")
    )
    parsed = [F.when(zoned, moved).otherwise(text.try_cast("timestamp_ntz"))]
    parsed += [
        F.try_to_timestamp(text, F.lit(layout)).cast("timestamp_ntz") for layout in layouts
    ]
    return F.coalesce(*parsed)


def comma_decimal(value: Column | str, precision: int = 18, scale: int = 6) -> Column:
    """Number written with a decimal comma; the usual markers become NULL."""
    text = F.trim(_col(value))
    return F.when(
        ~text.isin(*EMPTY_MARKERS), to_decimal(F.replace(text, F.lit(","), F.lit(".")), precision, scale)
    )


def marked_count(value: Column | str) -> Column:
    """Whole number with blanks as thousands marks; suppressed cells become NULL."""
    text = _col(value)
    return F.when(
        ~text.isin(*COUNT_MARKERS), F.replace(text, F.lit(" "), F.lit("")).try_cast("bigint")
    )


def truthy(value: Column | str) -> Column:
    return F.lower(_col(value)).isin(*TRUE_WORDS)


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_col(value), F.lit(""))


def digits(value: Column | str) -> Column:
    return F.regexp_replace(_col(value), "[^0-9]", "")


def match_key(value: Column | str) -> Column:
    """Join key for names typed by hand."""
    return F.upper(F.trim(_col(value)))


# Fixed value: the collation under which neither case nor accents tell words apart.
FOLDED = "UNICODE_CI_AI"


def folded(value: Column | str) -> Column:
    """The text under a collation that ignores case and accents; comparisons, joins and groups go by it."""
    return F.collate(_col(value), FOLDED)


def valid_cep(value: Column | str) -> Column:
    return digits(value).rlike(r"^\d{8}$")


def valid_cpf(value: Column | str) -> Column:
    """Eleven digits, not all alike, and both mod-11 check digits right."""
    number = digits(value)
    digit = [F.ascii(F.substring(number, place, 1)) - 48 for place in range(1, 12)]

    def check_digit(length: int) -> Column:
        weighted = sum((digit[i] * (length + 1 - i) for i in range(length)), F.lit(0))
        rest = 11 - weighted % 11
        return F.when(rest >= 10, 0).otherwise(rest)

    return (
        F.when(F.length(number) != 11, False)
        .when(number == F.repeat(F.substring(number, 1, 1), F.lit(11)), False)
        .otherwise((check_digit(9) == digit[9]) & (check_digit(10) == digit[10]))
    )
