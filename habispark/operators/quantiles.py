"""Exact interpolated quantiles per group that do not need a whole group in one task.

The values of a group are cut into segments by their magnitude, 1,024 to each doubling, so a segment is known from
the value alone: nothing is measured or sampled first, and a group of any size is spread over as many segments as
its values differ in scale. Counts per segment tell which one holds each wanted rank. A segment of one value
is the answer itself; only in segments of several values are these counted, and running counts within the
segment find the value. Segments are sorted by Spark, which spills; the rows are computed once, and one path serves
groups of all sizes. What a row has to carry through a shuffle decides the cost where groups are small: rows are
stored as they are, with all values side by side, and a segment travels as its least value and a count.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habispark.operators.skew import written

# Segments to each doubling of a value.
SEGMENTS = 1024
Extras = Mapping[str, tuple[Callable[[Column], Column], Column]]


def segment_of(value: Column, to_a_doubling: int) -> Column:
    """A whole number that never decreases as the value grows; equal values have equal ones."""
    size = F.abs(value)
    # Above the logarithm of any finite double.
    beyond = 2000 * to_a_doubling
    # The logarithm is monotone, though not exact; infinities and NaN, which sorts last, have segments of their own.
    steps = F.floor(F.log2(F.when((size > 0) & (size < float("inf")), size)) * to_a_doubling) + beyond
    return (
        F.when(F.isnan(value), 3 * beyond)
        .when(size == float("inf"), F.signum(value).cast("long") * 2 * beyond)
        .when(value == 0, 0)
        .otherwise(F.when(value > 0, steps).otherwise(-steps))
        .cast("long")
    )


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    quantiles: Mapping[str, tuple[str, float]],
    extras: Extras | None = None,
    weight: str | None = None,
) -> DataFrame:
    """`keys`, one column per entry of `extras`, then one double per entry of `quantiles`.

    `quantiles` maps an output name to (value column, probability). `extras` maps one to an aggregate and its
    argument; the aggregate must be its own sum of parts (`F.sum`, `F.min`, `F.max`). `weight` names a column
    that says how many times a row counts. A NULL key is a key like any other; a group without values has NULL quantiles.
    """
    extras = extras or {}
    names = list(dict.fromkeys(value for value, _ in quantiles.values()))
    held, values, inputs = [[f"{what}_{i}" for i in range(len(of))] for what, of in (("key", keys), ("value", names), ("extra", extras))]
    # Written, as ranks and values are looked up in two passes: the rows before it are computed once.
    rows = written(
        df.select(
            *[F.col(c).alias(h) for c, h in zip(keys, held, strict=True)],
            (F.lit(1) if weight is None else F.col(weight)).cast("long").alias("w"),
            *[value.alias(c) for c, (_, value) in zip(inputs, extras.values(), strict=True)],
            # Zeros of both signs are equal and count as one value.
            *[F.when(F.col(v) == 0, 0.0).otherwise(F.col(v)).cast("double").alias(c) for c, v in zip(values, names, strict=True)],
        ),
        "quantile-rows",
    )
    ranked = written(_ranked(rows, held, values, inputs, quantiles, extras), "quantile-ranks")
    # Stored apart: as it is small where groups are, it is known to be so when its joins are planned.
    unsettled = written(ranked.filter(F.size("open") > 0), "quantile-open").withColumn("k", F.struct(*held))
    found = _looked_up(rows, unsettled, held, values, quantiles)
    groups = [F.col(h).alias(c) for c, h in zip(keys, held, strict=True)]
    groups += [F.col(c).alias(name) for c, name in zip(inputs, extras, strict=True)]
    # Groups whose quantiles are all known need no join.
    settled = ranked.filter(F.size("open") == 0).select(
        *groups, *[F.col(f"answer_{j}").alias(name) for j, name in enumerate(quantiles)]
    )
    return settled.unionByName(
        unsettled.join(found, "k", "left").select(
            *groups, *[F.coalesce(f"answer_{j}", f"found_{j}").alias(name) for j, name in enumerate(quantiles)]
        )
    )


def _entries(rows: DataFrame, values: Sequence[str], *others: str) -> DataFrame:
    """One row per value: the number of its column as `measure`, and `v`; the first column also without a value."""
    entries = F.array(*[F.struct(F.lit(i).alias("measure"), F.col(c).alias("v")) for i, c in enumerate(values)])
    return rows.select(*others, F.inline(entries)).filter((F.col("measure") == 0) | F.col("v").isNotNull())


def _interpolated(position: Column, low: Column, high: Column) -> Column:
    """The interpolation of Spark's own percentile, bit by bit."""
    between = (F.ceil(position) - position) * low + (position - F.floor(position)) * high
    return F.when(low == high, low).otherwise(between)


def _ranked(
    rows: DataFrame,
    held: Sequence[str],
    values: Sequence[str],
    inputs: Sequence[str],
    quantiles: Mapping[str, tuple[str, float]],
    extras: Extras,
) -> DataFrame:
    """One row per group: extras, the quantiles whose segments have one value, and in `open` where to find the others."""
    entries = _entries(rows, values, *held, "w", *inputs).withColumn("segment", segment_of(F.col("v"), SEGMENTS))
    first = F.col("measure") == 0
    counted = entries.groupBy(*held, "measure", "segment").agg(
        F.sum(F.when(F.col("v").isNotNull(), F.col("w"))).alias("rows"),
        F.min("v").alias("least"),
        F.max("v").alias("greatest"),
        *[how(F.when(first, F.col(c))).alias(c) for c, (how, _) in zip(inputs, extras.values(), strict=True)],
    )
    # A group's segments meet in one task, as many as its values differ in scale. Least values have their order.
    # Dealt by group, so that the last grouping needs no further shuffle.
    dealt = counted.withColumn("greatest", F.nullif("greatest", "least")).drop("segment").repartition(*held)
    series = Window.partitionBy(*held, "measure")
    sized = dealt.withColumns(
        {"upto": F.sum("rows").over(series.orderBy("least")), "total": F.sum("rows").over(series)}
    )
    start = F.col("upto") - F.col("rows")
    names = list(dict.fromkeys(value for value, _ in quantiles.values()))
    ends = []
    for j, (value, p) in enumerate(quantiles.values()):
        position = (F.col("total") - 1) * F.lit(float(p))
        mine = F.col("measure") == names.index(value)
        ends.append(F.max(F.when(mine, position)).alias(f"position_{j}"))
        for end, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
            here = mine & (rank >= start) & (rank < F.col("upto"))
            place = F.struct("least", "greatest", (rank - start).alias("offset"))
            ends.append(F.max(F.when(here, place)).alias(f"{end}_{j}"))
    groups = sized.groupBy(*held).agg(*[how(F.col(c)).alias(c) for c, (how, _) in zip(inputs, extras.values(), strict=True)], *ends)
    answers, places = [], []
    for j, (value, _) in enumerate(quantiles.values()):
        position, low, high = F.col(f"position_{j}"), F.col(f"low_{j}"), F.col(f"high_{j}")
        known = low["greatest"].isNull() & high["greatest"].isNull()
        answers.append(F.when(known, _interpolated(position, low["least"], high["least"])).alias(f"answer_{j}"))
        for is_high, end in ((False, low), (True, high)):
            place = F.struct(
                F.lit(j).alias("name"),
                F.lit(is_high).alias("is_high"),
                position.alias("position"),
                F.lit(names.index(value)).alias("measure"),
                segment_of(end["least"], SEGMENTS).alias("segment"),
                end["offset"].alias("offset"),
            )
            places.append(F.when(~known, place))
    return groups.select(*held, *inputs, *answers, F.array_compact(F.array(*places)).alias("open"))


def _looked_up(
    rows: DataFrame, unsettled: DataFrame, held: Sequence[str], values: Sequence[str], quantiles: Mapping[str, tuple[str, float]]
) -> DataFrame:
    """`k` and the quantiles that lie in segments of several values, for the groups that have such."""
    # One struct as the key: its fields may be NULL and still join.
    k = F.struct(*held).alias("k")
    targets = unsettled.select("k", F.inline("open"))
    # Whole rows of those groups; a frequent group is split by the join, as its other side has one row for it.
    kept = rows.select(k, "w", *values).join(unsettled.select("k", "open"), "k")
    wanted = F.exists("open", lambda x: (x["measure"] == F.col("measure")) & (x["segment"] == F.col("segment")))
    # One column as the place, so that what follows is dealt by it and not by the group alone.
    place = F.struct("k", "measure", "segment").alias("place")
    counted = (
        _entries(kept, values, "k", "w", "open")
        .withColumn("segment", segment_of(F.col("v"), SEGMENTS))
        .filter(wanted)
        .select(place, "v", "w")
        .groupBy("place", "v")
        .agg(F.sum("w").alias("n"))
    )
    running = counted.withColumn("upto", F.sum("n").over(Window.partitionBy("place").orderBy("v")))
    found = running.join(targets.select("k", place, "name", "is_high", "position", "offset"), "place").filter(
        (F.col("offset") >= F.col("upto") - F.col("n")) & (F.col("offset") < F.col("upto"))
    )
    columns = []
    for j in range(len(quantiles)):
        mine = F.col("name") == j
        low, high = [F.max(F.when(mine & side, F.col("v"))) for side in (~F.col("is_high"), F.col("is_high"))]
        columns.append(_interpolated(F.max(F.when(mine, F.col("position"))), low, high).alias(f"found_{j}"))
    return found.groupBy("k").agg(*columns)
