"""Parts of the operators that deal with large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habispark.session import scratch_dir


def slot_of(edges: str, value: str, slots: int) -> Column:
    """How many of the `slots - 1` sorted edges lie below the value, by binary search.

    `slots` must be a power of two; NULL edges give NULL.
    """
    widths = F.array(*[F.lit(slots >> i) for i in range(1, slots.bit_length())])

    def step(found: Column, width: Column) -> Column:
        below = F.col(edges)[found + width - 1] < F.col(value)
        return F.when(below, found + width).otherwise(found)

    return F.when(F.col(edges).isNotNull(), F.aggregate(widths, F.lit(0), step))


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in the shared scratch folder, for rows that are read repeatedly."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
