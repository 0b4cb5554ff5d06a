"""Row numbers inside groups, also for groups that hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habispark.operators.quantiles import segment_of

# Slices to each doubling of a position.
SLICES = 4096


def numbered(df: DataFrame, key: str, order: Sequence[Column], position: Column, name: str = "rang") -> DataFrame:
    """Adds `name`: 0 for the first row of each `key` value, 1 for the second, and so on.

    `order` must be a total order. `position` is a number that never decreases along that order, or NULL for
    the first rows; it only says where a group is cut into slices. Rows are numbered within their slice and the
    sizes of the earlier slices are added, for groups of every size: a slice is known from the position
    alone, and is what a task sorts. Equal positions make a slice larger, never wrong.
    """
    slices = ["_key", "_slice"]
    cut = df.select(
        "*",
        # A struct, so that a NULL key joins like any other.
        F.struct(key).alias("_key"),
        F.coalesce(segment_of(position.cast("double"), SLICES), F.lit(-(2**62))).alias("_slice"),
    )
    within = cut.withColumn("_within", F.row_number().over(Window.partitionBy(*slices).orderBy(*order)) - 1)
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # Only slices behind another one of their group: few as a rule, so their size decides how they are joined.
    starts = (
        cut.groupBy(*slices)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_start", F.sum("_rows").over(earlier))
        .filter(F.col("_start").isNotNull())
        .drop("_rows")
    )
    joined = within.join(starts, slices, "left")
    number = (F.col("_within") + F.coalesce("_start", F.lit(0))).cast("long")
    return joined.select(*df.columns, number.alias(name))


def deduplicate_slugs(df: DataFrame, order: Sequence[Column], position: Column, slug: str = "slug") -> DataFrame:
    """The first row with a slug keeps it; the n-th one gets the suffix `-(n-1)`."""
    counted = numbered(df, slug, order, position)
    suffixed = F.when(F.col("rang") == 0, F.col(slug)).otherwise(
        F.concat(F.col(slug), F.lit("-"), F.col("rang"))
    )
    return counted.select(*[suffixed.alias(slug) if c == slug else F.col(c) for c in df.columns])
