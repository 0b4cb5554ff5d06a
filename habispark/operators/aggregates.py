"""The published aggregates: prices by commune and street, energy classes, price by energy class."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from habispark.constants import ENERGY_CLASSES
from habispark.functions import exact_mean, int_round, price_per_m2, sale_year
from habispark.operators.quantiles import grouped_quantiles


def _priced(sales: DataFrame) -> DataFrame:
    return sales.filter(F.col("surface_reelle_bati") > 0).withColumn("prix_m2", price_per_m2())


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: int_round(F.col(n)) for n in names})


def commune_prices(sales: DataFrame) -> DataFrame:
    """Sales, median price, price per m² quartiles and median surface by commune, year and type."""
    keys = ["code_insee", "annee", "type_local"]
    rows = _priced(sales).select(
        F.col("code_commune").alias("code_insee"),
        sale_year().alias("annee"),
        "type_local",
        F.col("valeur_fonciere").cast("double").alias("prix"),
        "prix_m2",
        F.col("surface_reelle_bati").cast("double").alias("surface"),
    )
    table = grouped_quantiles(
        rows,
        keys,
        {
            "prix_median": ("prix", 0.5),
            "prix_m2_median": ("prix_m2", 0.5),
            "prix_m2_p25": ("prix_m2", 0.25),
            "prix_m2_p75": ("prix_m2", 0.75),
            "surface_mediane": ("surface", 0.5),
        },
        {"nb_ventes": (F.sum, F.lit(1))},
    )
    return _rounded(
        table, "prix_median", "prix_m2_median", "prix_m2_p25", "prix_m2_p75", "surface_mediane"
    )


def sale_counts(sales: DataFrame) -> DataFrame:
    """Sales by commune, the part of `commune_prices` that the coverage rule needs."""
    counted = sales.filter(F.col("surface_reelle_bati") > 0)
    return counted.groupBy(F.col("code_commune").alias("code_insee")).agg(
        F.count(F.lit(1)).alias("nb_ventes")
    )


def commune_energy(certificates: DataFrame) -> DataFrame:
    """Certificates, share in percent and mean consumption by commune and energy class.

    The window runs over grouped rows: at most one per class and commune.
    """
    counted = (
        certificates.filter(
            F.col("classe_dpe").isin(*ENERGY_CLASSES)
            & F.col("code_insee").isNotNull()
            & (F.col("code_insee") != "")
        )
        .groupBy("code_insee", "classe_dpe")
        .agg(
            F.count(F.lit(1)).alias("nb_logements"),
            exact_mean(F.col("conso_energie"), 1).alias("conso_moyenne"),
        )
    )
    commune = Window.partitionBy("code_insee")
    share = F.lit(100.0) * F.col("nb_logements") / F.sum("nb_logements").over(commune)
    return counted.select(
        "code_insee", "classe_dpe", "nb_logements", F.round(share, 1).alias("part_pct"), "conso_moyenne"
    )


def street_prices(sales: DataFrame) -> DataFrame:
    """Sales, median price per m² and last sale date by street."""
    rows = _priced(sales.filter(F.col("id_voie").isNotNull())).select(
        "id_voie", "prix_m2", F.col("date_mutation").cast("date").alias("date_mutation")
    )
    table = grouped_quantiles(
        rows,
        ["id_voie"],
        {"prix_m2_median": ("prix_m2", 0.5)},
        {"nb_ventes": (F.sum, F.lit(1)), "derniere_vente": (F.max, F.col("date_mutation"))},
    )
    return _rounded(table, "prix_m2_median").select(
        "id_voie", "nb_ventes", "prix_m2_median", "derniere_vente"
    )


def matched_prices(matched_sales: DataFrame, certificates: DataFrame) -> DataFrame:
    """Price per m² of each sale and class of its certificate, with the number of certificates as weight `poids`.

    `matched_sales` carries the certificate number in `dpe_numero`. Certificates are first counted by
    number and class, so a number that occurs often meets each sale once per class instead of
    once per certificate.
    """
    classes = (
        certificates.filter(
            F.col("classe_dpe").isin(*ENERGY_CLASSES) & F.col("numero_dpe").isNotNull()
        )
        .groupBy("numero_dpe", "classe_dpe")
        .agg(F.count(F.lit(1)).alias("poids"))
    )
    sales = _priced(matched_sales).select(F.col("code_commune").alias("code_insee"), "type_local", "dpe_numero", "prix_m2")
    return sales.join(classes, F.col("dpe_numero") == F.col("numero_dpe")).select(
        "code_insee", "type_local", "classe_dpe", "prix_m2", "poids"
    )


def prices_by_energy_class(matched_sales: DataFrame, certificates: DataFrame) -> DataFrame:
    """Observations and median price per m² by commune, dwelling type and energy class."""
    table = grouped_quantiles(
        matched_prices(matched_sales, certificates),
        ["code_insee", "type_local", "classe_dpe"],
        {"prix_m2_median": ("prix_m2", 0.5)},
        {"nb_observations": (F.sum, F.col("poids"))},
        weight="poids",
    )
    return _rounded(table, "prix_m2_median")
