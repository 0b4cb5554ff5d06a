"""Small numeric and date expressions shared by the aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_round(value: Column) -> Column:
    """Nearest integer, ties to even. A plain cast would truncate."""
    return F.rint(value).cast("int")


def exact_mean(value: Column, digits: int) -> Column:
    """Aggregate: the mean rounded half away from zero, the same however rows are split and ordered.

    Whole numbers and billionths are added up apart, as integers, and divided as integers. Values are taken as
    the decimals they are printed as, to nine digits; those beyond 2**62 raise an error.
    """
    too_large = F.raise_error(F.lit("value too large for an exact mean")).cast("double")
    value = F.when(F.abs(value) < float(2**62), value).when(value.isNotNull(), too_large)
    whole = F.floor(value)
    parts = F.round((value - whole) * 1e9).cast("long")
    billion = F.lit(10**9)
    total = F.sum(whole).cast("decimal(20,0)") * billion + F.sum(parts).cast("decimal(20,0)")
    units = F.count(value).cast("decimal(20,0)") * billion
    # Half the divisor is added before the division, so that it rounds.
    rounded = F.call_function("div", F.abs(total) * F.lit(2 * 10**digits) + units, units * F.lit(2))
    return F.when(F.count(value) > 0, F.signum(total) * rounded.cast("double") / float(10**digits))


def price_per_m2(price: str = "valeur_fonciere", surface: str = "surface_reelle_bati") -> Column:
    """Price divided by built surface; callers keep only rows with a positive surface."""
    return F.col(price).cast("double") / F.col(surface).cast("double")


def sale_year(date: str = "date_mutation") -> Column:
    """Year of a date or ISO date text; text that is no date raises under ANSI mode."""
    return F.year(F.col(date).cast("date"))
