"""Restrictions by département, postal code and period."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from habispark.constants import DEFAULT_YEARS
from habispark.sources import read_table, stored_years


def sale_in_department(code: str) -> Column:
    column = F.col("code_departement")
    return column.isNull() | (column == code)


def certificate_in_department(code: str) -> Column:
    column = F.col("code_insee")
    # A prefix test reaches the Parquet scan.
    return column.isNull() | column.startswith(code)


def sales_of_department(sales: DataFrame, code: str) -> DataFrame:
    """Rows of one département, and rows without any."""
    return sales.filter(sale_in_department(code))


def certificates_of_department(certificates: DataFrame, code: str) -> DataFrame:
    """Rows whose commune code starts with a 2- or 3-character code, and rows without a commune."""
    return certificates.filter(certificate_in_department(code))


def communes_of_department(communes: DataFrame, code: str) -> DataFrame:
    """Communes of one département; apply it after slugs are numbered."""
    return communes.filter(F.col("code_departement") == code)


def certificates_of_postcode(certificates: DataFrame, code: str) -> DataFrame:
    return certificates.filter(F.col("code_postal") == code)


def sales_of_years(sales: DataFrame, years: Iterable[int], column: str = "annee_fichier") -> DataFrame:
    return sales.filter(F.col(column).isin(*years))


def latest_years(
    sales: DataFrame,
    n: int = DEFAULT_YEARS,
    column: str = "annee_fichier",
    years_from: DataFrame | None = None,
) -> DataFrame:
    """Rows of the `n` latest years present; `years_from` may be a cheaper frame to list them."""
    years = latest_values(sales if years_from is None else years_from, n, column)
    # At most n rows.
    return sales.join(F.broadcast(years), F.col(column) == F.col("year"), "left_semi")


def latest_stored_years(spark: SparkSession, path: str, n: int = DEFAULT_YEARS, column: str = "annee_fichier") -> DataFrame:
    """Rows of the `n` latest years of a table stored by year: the years are folder names, and only theirs are read."""
    years = [row.year for row in latest_values(stored_years(spark, path, column), n, column).collect()]
    return sales_of_years(read_table(spark, path), years, column)


def latest_values(df: DataFrame, n: int, column: str = "annee_fichier") -> DataFrame:
    """The `n` largest values of a column, as column `year`."""
    values = df.select(F.col(column).alias("year")).distinct()
    return values.orderBy(F.col("year").desc_nulls_last()).limit(n)


def missing_years(sales: DataFrame, requested: Iterable[int], column: str = "annee_fichier") -> DataFrame:
    """Requested years that the table does not hold, as column `annee`."""
    years = F.explode(F.array(*[F.lit(int(y)) for y in requested])).alias("annee")
    wanted = sales.sparkSession.range(0, 1, 1, 1).select(years)
    present = sales.select(F.col(column).alias("present")).distinct()
    return wanted.join(present, F.col("annee") == F.col("present"), "left_anti")
