"""Null-safe financial expressions: a null input or a zero denominator gives null, negative inputs stay negative."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def divide(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def growth(current: Column, previous: Column) -> Column:
    return F.try_divide(current - previous, F.abs(previous))


def cagr(end: Column, start: Column, years: int) -> Column:
    """Null unless start is positive, end isn't negative and years is positive."""
    if years <= 0:
        return F.lit(None).cast("double")
    return F.when((end >= 0) & (start > 0), F.pow((end / start).cast("double"), F.lit(1.0 / years)) - 1)


def return_on_average(profit: Column, current: Column, previous: Column) -> Column:
    """Profit over the mean of opening and closing base, both of which must be there (ROE, ROA)."""
    return F.try_divide(profit, (current + previous) / 2)


def net_debt(debt: Column, cash: Column) -> Column:
    return debt - cash


def free_cash_flow(operating: Column, capex: Column) -> Column:
    return operating - F.abs(capex)


def positive(x: Column) -> Column:
    """x as a base of a ratio: null where the ratio would have no meaning."""
    return F.when(x > 0, x)


def not_meaningful(x: Column, what: str) -> Column:
    """A note where a base is there but not positive."""
    return F.when(x <= 0, F.lit(f"not meaningful: {what} is not positive"))


def near(value: Column, reference: Column, tolerance: float) -> Column:
    return F.coalesce((reference != 0) & (F.abs(value - reference) <= F.abs(reference) * tolerance), F.lit(False))


def implied_shares(market_cap: Column, price: Column) -> Column:
    """Half-even rounding of the quotient; null for a price of zero."""
    return F.bround(F.try_divide(market_cap, price), 0)


def plausible_ytd(ytd: Column, annual: Column, months: Column) -> Column:
    """Whether the share of the year is within a quarter and four times that of its months; both ends count."""
    share, expected = F.abs(F.try_divide(ytd, annual)), months / F.lit(12.0)
    return F.coalesce(share.between(expected / 4, expected * 4), F.lit(False))


def trailing(annual: Column, ytd: Column, prior: Column, annual_end: Column, current_end: Column, prior_end: Column, months: Column) -> Column:
    """Year plus year-to-date less the year-to-date before, if the periods prove that the three fit."""
    fits = (
        months.between(1, 11) & (current_end > annual_end) & (F.month(current_end) == F.month(prior_end)) & (F.dayofmonth(current_end) == F.dayofmonth(prior_end))
        & (F.year(current_end) - F.year(prior_end) == 1) & (prior_end <= annual_end)
    )
    return F.when(fits, annual + ytd - prior)
