"""Coverage rule: which communes have enough sales and certificates to be published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habispark.constants import MIN_CERTIFICATES, MIN_SALES


def eligible_communes(
    communes: DataFrame,
    prices: DataFrame,
    energy: DataFrame,
    min_sales: int = MIN_SALES,
    min_certificates: int = MIN_CERTIFICATES,
) -> DataFrame:
    """Communes whose `nb_ventes` and `nb_logements` both add up to the minimum."""

    def enough(table: DataFrame, count: str, minimum: int) -> DataFrame:
        totals = table.groupBy("code_insee").agg(F.sum(count).alias("total"))
        return totals.filter(F.col("total") >= minimum).select("code_insee")

    return (
        communes.select("code_insee", "nom")
        .join(enough(prices, "nb_ventes", min_sales), "code_insee", "left_semi")
        .join(enough(energy, "nb_logements", min_certificates), "code_insee", "left_semi")
    )
