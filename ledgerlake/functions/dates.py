"""Calendar expressions. A reference day is always an argument, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.text import _col

# The day ages are counted to, and the open end of a validity period.
REFERENCE_DAY = dt.date(2026, 6, 10)
OPEN_END = dt.date(9999, 12, 31)

# Calendar names, kept here so that no server locale can change them.
MONTHS = {
    "en": ["January", "February", "March", "April", "May", "June", "July", "August",
           "September", "October", "November", "December"],
    "pt": ["Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho", "Agosto",
           "Setembro", "Outubro", "Novembro", "Dezembro"],
}
WEEKDAYS = {
    "en": ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"],
    "pt": ["Domingo", "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado"],
}
MONTH_CODES = ["JAN", "FEV", "MAR", "ABR", "MAI", "JUN", "JUL", "AGO", "SET", "OUT", "NOV", "DEZ"]


def day(value: dt.date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def pick(names: list[str], position: Column) -> Column:
    """The name at a 1-based position."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), position.cast("int"))


def age_years(birth: Column | str, as_of: dt.date | str | Column = REFERENCE_DAY) -> Column:
    """Whole years lived; someone born on 29 February has a birthday on 1 March in common years."""
    birth, as_of = _col(birth), day(as_of)

    def month_day(d: Column) -> Column:
        return F.month(d) * 100 + F.dayofmonth(d)

    early = F.when(month_day(as_of) < month_day(birth), 1).otherwise(0)
    return F.year(as_of) - F.year(birth) - early


def month_start(value: Column | str) -> Column:
    return F.trunc(_col(value), "month")


def month_label(value: Column | str) -> Column:
    return F.date_format(_col(value), "yyyy-MM")


def weekday(value: Column | str) -> Column:
    """0 is Sunday, 6 is Saturday."""
    return F.dayofweek(_col(value)) - 1


def is_weekend(value: Column | str) -> Column:
    return weekday(value).isin(0, 6)


def is_working_day(weekend: Column | str, holiday: Column | str) -> Column:
    return ~(_col(weekend) | _col(holiday))


def weekdays_in_month(value: Column | str) -> Column:
    """Mondays to Fridays in the month of the given day, by arithmetic on its first weekday."""
    start = month_start(value)
    length = F.dayofmonth(F.last_day(start))
    first = (weekday(start) + 6) % 7  # 0 is Monday
    extra = length - 28
    weekend_extra = F.greatest(F.lit(0), F.least(first + extra, F.lit(7)) - F.greatest(first, F.lit(5)))
    return (20 + extra - weekend_extra).cast("int")
