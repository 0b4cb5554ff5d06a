"""Cleaning of energy-performance certificates; every function works on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habispark.constants import CERTIFICATE_FIELDS
from habispark.functions import lenient_integer, lenient_number


def rename_certificates(df: DataFrame) -> DataFrame:
    """Service field names to column names; other columns pass through."""
    return df.withColumnsRenamed(CERTIFICATE_FIELDS)


def unique_certificates(df: DataFrame) -> DataFrame:
    """One row per certificate number, the latest and then the greatest one; rows without a number all stay.

    The columns that say how a row was landed (`perimetre`, `lot`) go.
    """
    rows = df.drop("perimetre", "lot")
    others = ["date_etablissement", *[c for c in rows.columns if c not in ("numero_dpe", "date_etablissement")]]
    numbered = (
        rows.filter(F.col("numero_dpe").isNotNull())
        .groupBy("numero_dpe")
        .agg(F.max(F.struct(*others)).alias("latest"))
        .select("numero_dpe", "latest.*")
    )
    return numbered.unionByName(rows.filter(F.col("numero_dpe").isNull())).select(*rows.columns)


def clean_certificates(df: DataFrame) -> DataFrame:
    """Renamed columns with numeric consumption, surface and construction year."""
    return rename_certificates(df).withColumns(
        {
            "conso_energie": lenient_number(F.col("conso_energie").cast("string")),
            "surface_habitable": lenient_number(F.col("surface_habitable").cast("string")),
            "annee_construction": lenient_integer(F.col("annee_construction").cast("string")),
        }
    )
