"""The commune reference: selection, names, unique slugs and coordinates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habispark.constants import COMMUNE_COLUMNS, DEPARTMENT_NAMES, REGION_NAMES
from habispark.functions import lenient_number, slugify
from habispark.operators.numbering import deduplicate_slugs


def communes_and_districts(cog: DataFrame) -> DataFrame:
    """Communes and municipal districts of the official list; other kinds of entity are dropped."""
    return cog.filter(F.col("TYPECOM").isin("COM", "ARM"))


def lookup_name(df: DataFrame, names: Mapping[str, str], code: str, name: str) -> DataFrame:
    """Adds the name of a code from a fixed dictionary, '' where the code is unknown or NULL."""
    pairs = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    table = df.sparkSession.range(0, 1, 1, 1).select(F.explode(pairs).alias("known_code", "known_name"))
    # One row per dictionary entry, about a hundred at most.
    joined = df.join(F.broadcast(table), F.col(code) == F.col("known_code"), "left")
    return joined.withColumn(name, F.coalesce("known_name", F.lit(""))).drop("known_code", "known_name")


def code_position(code: Column) -> Column:
    """A number that never decreases along the byte order of a code of any length (its first six bytes)."""
    head = F.rpad(F.hex(F.substring(F.encode(code, "UTF-8"), 1, 6)), 12, "0")
    return F.coalesce(F.conv(head, 16, 10).cast("double"), F.lit(-1.0))


def build_communes(cog: DataFrame) -> DataFrame:
    """The communes table in its final column order, coordinates still empty.

    Slugs are numbered communes first, then districts, each by code.
    """
    rows = communes_and_districts(cog).select(
        F.col("COM").alias("code_insee"),
        F.col("LIBELLE").alias("nom"),
        F.col("DEP").alias("code_departement"),
        F.col("REG").alias("code_region"),
        (F.col("TYPECOM") == "ARM").cast("int").alias("district"),
        slugify(F.col("LIBELLE")).alias("slug"),
    )
    # Codes take less than 2**48, so districts come after all communes.
    position = F.col("district") * F.lit(float(2**48)) + code_position(F.col("code_insee"))
    unique = deduplicate_slugs(rows, [F.col("district"), F.col("code_insee")], position)
    named = lookup_name(unique, DEPARTMENT_NAMES, "code_departement", "nom_departement")
    named = lookup_name(named, REGION_NAMES, "code_region", "nom_region")
    return named.withColumns(
        {
            "codes_postaux": F.lit(""),
            "population": F.lit(None).cast("long"),
            "latitude": F.lit(None).cast("double"),
            "longitude": F.lit(None).cast("double"),
        }
    ).select(*COMMUNE_COLUMNS)


def first_non_null(
    df: DataFrame,
    key: str,
    values: Sequence[str],
    order: Sequence[str],
    convert: Callable[[Column], Column] = lambda value: value,
) -> DataFrame:
    """Per key, the first value that is present in each column, which may come from different rows.

    `convert` is applied to every value, without changing which one is the first: a present value may
    convert to NULL. Numbers ordered by a number aggregate by hash, where text needs a sort.
    """
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return df.groupBy(key).agg(
        *[F.min_by(convert(F.col(v)), F.when(F.col(v).isNotNull(), rank)).alias(v) for v in values]
    )


def add_coordinates(communes: DataFrame, geocoded: DataFrame, order: Sequence[str]) -> DataFrame:
    """Communes with the first coordinates found for them; others keep what they had.

    A geocoder answer without the expected columns leaves the communes as they are.
    """
    if not {"result_citycode", "latitude"} <= set(geocoded.columns):
        return communes

    def number(text: Column) -> Column:
        return lenient_number(text.cast("string"))

    first = first_non_null(geocoded, "code_insee", ["latitude", "longitude"], order, number)
    joined = communes.join(
        first.withColumnsRenamed({"latitude": "found_latitude", "longitude": "found_longitude"}),
        "code_insee",
        "left",
    ).withColumns(
        {
            "latitude": F.coalesce("found_latitude", "latitude"),
            "longitude": F.coalesce("found_longitude", "longitude"),
        }
    )
    return joined.select(*communes.columns)


def duplicate_slugs(communes: DataFrame, slug: str = "slug") -> DataFrame:
    """Slugs that more than one row carries."""
    return communes.groupBy(slug).agg(F.count(F.lit(1)).alias("nb")).filter(F.col("nb") > 1)


def communes_profile(communes: DataFrame) -> DataFrame:
    """One row: communes, distinct slugs, communes with coordinates."""
    return communes.agg(
        F.count(F.lit(1)).alias("communes"),
        F.count_distinct("slug").alias("slugs_uniques"),
        F.count("latitude").alias("avec_coordonnees"),
    )
