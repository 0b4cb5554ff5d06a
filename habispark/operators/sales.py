"""Cleaning of property-sale rows: which rows are usable, which deeds are dropped, and the counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from habispark.constants import DWELLING_TYPES, MIN_SURFACE_M2, RETENTION_BAND, SALE_NATURE
from habispark.functions import lenient_number, parse_decimal_comma

FUNNEL_COUNTS = (
    "lignes_brutes",
    "exclues_non_vente",
    "exclues_type_local",
    "exclues_prix_manquant",
    "exclues_surface_faible",
    "exclues_multi_lots",
    "lignes_multi_lots",
    "lignes_retenues",
)
# Values of the second join key of a deed: small numbers, as every sale carries one through the shuffle.
SPREADS = 16


def with_numbers(df: DataFrame) -> DataFrame:
    """Price and surface as doubles; text is parsed leniently, numbers stay as they are."""

    def number(name: str, parse) -> Column:
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        return parse(F.col(name)) if is_text else F.col(name).cast("double")

    return df.withColumns(
        {
            "valeur_fonciere": number("valeur_fonciere", parse_decimal_comma),
            "surface_reelle_bati": number("surface_reelle_bati", lenient_number),
        }
    )


def _conditions() -> tuple[Column, Column, Column, Column]:
    """The four conditions, plain comparisons that Parquet scans can take over.

    Spark orders NaN above infinity, so the upper bound excludes both.
    """
    infinity = F.lit(float("inf"))
    price, surface = F.col("valeur_fonciere"), F.col("surface_reelle_bati")
    return (
        F.col("nature_mutation") == SALE_NATURE,
        F.col("type_local").isin(*DWELLING_TYPES),
        (price > 0) & (price < infinity),
        (surface > MIN_SURFACE_M2) & (surface < infinity),
    )


def usable_sales(df: DataFrame) -> DataFrame:
    """Sales of a house or flat with a positive price and more than the minimum surface."""
    sale, dwelling, priced, large = _conditions()
    return df.filter(sale & dwelling & priced & large)


def multi_parcel_deeds(usable: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Deeds with more than one distinct parcel; `scope` columns say where a deed id is unique.

    Two distinct values exist exactly when the smallest and the largest differ, which needs no set of
    parcels per deed and combines before the shuffle.
    """
    deed = [*scope, "id_mutation"]
    return (
        usable.filter(F.col("id_mutation").isNotNull())
        .groupBy(*deed)
        .agg(F.min("id_parcelle").alias("first"), F.max("id_parcelle").alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select(*deed)
    )


def single_parcel_sales(usable: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Usable sales without the deeds of several parcels; rows without a deed id stay.

    The second join key repeats a few bits of the deed id's hash. Rows without an id match nothing, so theirs is
    a hash of columns read anyway and spreads them over all tasks. The extra key also makes Spark
    shuffle both sides for this join, the shape in which adaptive execution splits a deed that is
    very frequent.
    """
    deed = [*scope, "id_mutation"]
    # The parcel is left out: few results need it, and it would be shuffled for this hash alone.
    of_row = F.xxhash64("valeur_fonciere", "surface_reelle_bati")
    of_deed = F.xxhash64("id_mutation") % SPREADS
    spread = F.when(F.col("id_mutation").isNull(), of_row).otherwise(of_deed)
    several = multi_parcel_deeds(usable, scope).withColumn("spread", of_deed)
    return usable.withColumn("spread", spread).join(several, [*deed, "spread"], "left_anti").drop("spread")


def clean_sales(raw: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Raw rows to usable sales of single-parcel deeds."""
    return single_parcel_sales(usable_sales(with_numbers(raw)), scope)


def sales_funnel(raw: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many rows each cleaning step removes, in total or per `by`, from one pass over the rows.

    Rows are grouped by deed only if they are usable. All others share one group, so they shrink to
    a row per input task before the shuffle, which then carries usable deeds alone.
    """
    sale, dwelling, priced, large = [F.coalesce(c, F.lit(False)) for c in _conditions()]
    usable = sale & dwelling & priced & large
    deeds = (
        with_numbers(raw)
        .groupBy(*by, F.when(usable, F.col("id_mutation")).alias("deed"))
        .agg(
            F.count(F.lit(1)).alias("lignes_brutes"),
            F.count_if(~sale).alias("exclues_non_vente"),
            F.count_if(sale & ~dwelling).alias("exclues_type_local"),
            F.count_if(sale & dwelling & ~priced).alias("exclues_prix_manquant"),
            F.count_if(sale & dwelling & priced & ~large).alias("exclues_surface_faible"),
            F.count_if(usable).alias("usable"),
            F.min(F.when(usable, F.col("id_parcelle"))).alias("first"),
            F.max(F.when(usable, F.col("id_parcelle"))).alias("last"),
        )
    )
    several = F.col("deed").isNotNull() & F.coalesce(F.col("first") != F.col("last"), F.lit(False))
    summed = [
        F.coalesce(F.sum(c), F.lit(0)).alias(c)
        for c in (
            "lignes_brutes",
            "exclues_non_vente",
            "exclues_type_local",
            "exclues_prix_manquant",
            "exclues_surface_faible",
        )
    ]
    counts = deeds.groupBy(*by).agg(
        *summed,
        F.count_if(several).alias("exclues_multi_lots"),
        F.coalesce(F.sum(F.when(several, F.col("usable"))), F.lit(0)).alias("lignes_multi_lots"),
        F.coalesce(F.sum(F.when(~several, F.col("usable"))), F.lit(0)).alias("lignes_retenues"),
    )
    return _with_rate(counts)


def sales_funnel_total(funnel: DataFrame, by: str) -> DataFrame:
    """A funnel per `by` plus one row over everything, where `by` is NULL; rates are recomputed."""
    return _with_rate(
        funnel.rollup(by).agg(*[F.sum(c).alias(c) for c in FUNNEL_COUNTS])
    )


def _with_rate(counts: DataFrame) -> DataFrame:
    rate = F.round(100 * F.col("lignes_retenues").cast("double") / F.col("lignes_brutes"), 1)
    return counts.withColumn(
        "taux_retention_pct", F.when(F.col("lignes_brutes") > 0, rate).otherwise(F.lit(0.0))
    )


def retention_status(rate: str = "taux_retention_pct") -> Column:
    """'warn' when a retention rate lies outside the expected band, else 'ok'."""
    low, high = RETENTION_BAND
    return F.when((F.col(rate) < low) | (F.col(rate) > high), "warn").otherwise("ok")
