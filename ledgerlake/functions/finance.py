"""Money arithmetic. Amounts are decimals, rounded half away from zero."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.dates import day
from ledgerlake.functions.text import _col

# Fixed value: business days in a rate year.
RATE_DAYS = 252


def share_pct(part: Column | str, whole: Column | str, places: int = 2) -> Column:
    """Percentage of a whole; NULL when the whole is zero."""
    return F.round(
        _col(part).cast("double") * 100 / F.nullif(_col(whole).cast("double"), F.lit(0.0)), places
    )


def annuity(amount: Column | str, rate: Column | str, months: Column | str) -> Column:
    """Level instalment of a loan at a monthly rate; NULL when the rate or term is zero."""
    amount, rate = _col(amount).cast("double"), _col(rate).cast("double")
    growth = F.pow(1 + rate, _col(months).cast("double"))
    return F.round(amount * (rate * growth) / F.nullif(growth - 1, F.lit(0.0)), 2)


def current_value(applied: Column | str, gain: Column | str) -> Column:
    return F.round(_col(applied) * (1 + _col(gain)), 2)


def maturity_status(due: Column | str, as_of: dt.date | str | Column) -> Column:
    """A position without a due date, or due later, is active."""
    return F.when(_col(due) <= day(as_of), "Vencido").otherwise("Ativo")


def utilisation_pct(spent: Column | str, limit: Column | str) -> Column:
    limit = _col(limit)
    return F.when(limit > 0, F.round(_col(spent) / F.nullif(limit, F.lit(0)) * 100, 2)).otherwise(0)


def available_limit(limit: Column | str, spent: Column | str) -> Column:
    return F.round(_col(limit) - _col(spent), 2)


def in_dollars(value: Column | str, rate: Column | str) -> Column:
    rate = _col(rate)
    return F.when(rate > 0, F.round(_col(value) / F.nullif(rate, F.lit(0)), 2))


def daily_rate(annual: Column | str) -> Column:
    return F.round(_col(annual) / RATE_DAYS, 6)


def opportunity_cost(value: Column | str, annual: Column | str) -> Column:
    return F.round(_col(value) * (_col(annual) / 100 / RATE_DAYS), 2)


def annual_rate(daily: Column | str) -> Column:
    return _col(daily) * RATE_DAYS * 100


def margin(revenue: Column | str, cost: Column | str) -> Column:
    return _col(revenue) - F.coalesce(_col(cost), F.lit(0))


def full_name(first: Column | str, last: Column | str) -> Column:
    return F.concat(_col(first), F.lit(" "), _col(last))
