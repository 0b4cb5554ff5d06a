"""Blocking checks on the aggregates; each one is a query that returns the rows that break a rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from habispark.constants import (
    PRICE_M2_BOUNDS,
    SAMPLE_ROWS,
    SHARE_BOUNDS,
    SHARE_TOLERANCE,
    SHARE_TOTAL,
)


class QualityError(RuntimeError):
    """A check found rows that must not be published: its name, their number and a few of them."""

    def __init__(self, message: str, check: str = "", rows: int = 0, examples: Sequence[tuple] = ()):
        super().__init__(message)
        self.check, self.rows, self.examples = check, rows, list(examples)


def price_out_of_bounds(prices: DataFrame, bounds: tuple[float, float] = PRICE_M2_BOUNDS) -> DataFrame:
    low, high = bounds
    return prices.filter((F.col("prix_m2_median") < low) | (F.col("prix_m2_median") > high)).select(
        "code_insee", "annee", "type_local", "prix_m2_median"
    )


def share_out_of_bounds(energy: DataFrame, bounds: tuple[float, float] = SHARE_BOUNDS) -> DataFrame:
    low, high = bounds
    return energy.filter((F.col("part_pct") < low) | (F.col("part_pct") > high)).select(
        "code_insee", "classe_dpe", "part_pct"
    )


def share_total_off(
    energy: DataFrame, total: float = SHARE_TOTAL, tolerance: float = SHARE_TOLERANCE
) -> DataFrame:
    sums = energy.groupBy("code_insee").agg(F.sum("part_pct").alias("total"))
    return sums.filter(F.abs(F.col("total") - total) > tolerance)


def communes_without_department(prices: DataFrame, communes: DataFrame) -> DataFrame:
    """One row per aggregate row whose commune is unknown or has no département."""
    known = communes.select("code_insee", "code_departement")
    joined = prices.select("code_insee").join(known, "code_insee", "left")
    return joined.filter(F.col("code_departement").isNull()).select("code_insee")


def violations(
    prices: DataFrame,
    energy: DataFrame,
    communes: DataFrame,
    price_bounds: tuple[float, float] = PRICE_M2_BOUNDS,
) -> dict[str, DataFrame]:
    """All checks, in the order in which they are to be run."""
    return {
        "prix_m2_bornes": price_out_of_bounds(prices, price_bounds),
        "part_pct_bornes": share_out_of_bounds(energy),
        "part_pct_somme": share_total_off(energy),
        "communes_departement": communes_without_department(prices, communes),
    }


def require_no_violation(checks: Mapping[str, DataFrame]) -> None:
    """Raises on the first check with rows, naming a few of them."""
    for name, bad in checks.items():
        rows, examples = offenders(bad)
        if rows:
            raise QualityError(f"{name}: {rows} rows break the rule, for example {examples}", name, rows, examples)


def offenders(bad: DataFrame, most: int = SAMPLE_ROWS) -> tuple[int, list[tuple]]:
    """How many rows a check found, and the first `most` of them in the order of their columns.

    One job: the sort keeps `most` rows a task but has to see all of them, and they are counted on the way.
    """
    seen = Observation()
    first = bad.observe(seen, F.count(F.lit(1)).alias("rows")).orderBy(*bad.columns).limit(most).collect()
    return (seen.get["rows"], [tuple(row) for row in first]) if first else (0, [])


def offender_samples(checks: Mapping[str, DataFrame], most: int = SAMPLE_ROWS) -> DataFrame:
    """controle, lignes, rang, exemple: the first `most` offenders of each check, as text, and how many there are."""
    kept = []
    for name, bad in checks.items():
        rows, examples = offenders(bad, most)
        kept += [
            (name, rows, i, "|".join(str(x) for x in example if x is not None)) for i, example in enumerate(examples, 1)
        ]
    # At most `most` rows per check.
    spark = next(iter(checks.values())).sparkSession
    return spark.createDataFrame(kept, "controle string, lignes long, rang int, exemple string")


def quality_counts(prices: DataFrame, energy: DataFrame, communes: DataFrame) -> DataFrame:
    """`quality_report` over all checks, in one pass over prices and one over energy shares."""
    (low, high), (least, most) = PRICE_M2_BOUNDS, SHARE_BOUNDS
    known = communes.groupBy("code_insee").agg(F.max("code_departement").alias("code_departement"))
    median, share = F.col("prix_m2_median"), F.col("part_pct")
    of_prices = prices.select("code_insee", "prix_m2_median").join(known, "code_insee", "left").agg(
        F.count_if((median < low) | (median > high)).alias("prix_m2_bornes"),
        F.count_if(F.col("code_departement").isNull()).alias("communes_departement"),
    )
    of_shares = (
        energy.groupBy("code_insee")
        .agg(F.count_if((share < least) | (share > most)).alias("off"), F.sum(share).alias("total"))
        .agg(
            F.coalesce(F.sum("off"), F.lit(0)).alias("part_pct_bornes"),
            F.count_if(F.abs(F.col("total") - SHARE_TOTAL) > SHARE_TOLERANCE).alias("part_pct_somme"),
        )
    )
    counts = [
        df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("controle"), F.col(c).alias("lignes")) for c in df.columns])))
        for df in (of_prices, of_shares)
    ]
    status = F.when(F.col("lignes") > 0, "ko").otherwise("ok")
    return reduce(DataFrame.unionByName, counts).withColumn("statut", status)


def quality_report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """All checks at once: name, number of rows that break the rule, status."""
    counts = [
        bad.agg(F.count(F.lit(1)).alias("lignes")).select(F.lit(name).alias("controle"), "lignes")
        for name, bad in checks.items()
    ]
    status = F.when(F.col("lignes") > 0, "ko").otherwise("ok")
    return reduce(DataFrame.unionByName, counts).withColumn("statut", status)
