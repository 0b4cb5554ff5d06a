"""How five filters act together, whatever the order they are applied in.

Each filter has a relation of its own with the ids of the rows that fail it. The survivors of a set of
filters are the rows left by one left-anti join per filter of the set; what a further filter removes are
those of its failing rows (a left-semi join) that the set has left. What a filter meets depends only on
the set before it, so 32 sets answer all 120 orders, and each filter needs one join for all sets at once:
every row goes into it twice, with the filter in its set and without, and only the former can be dropped.

All joins are on the row id alone, so the rows and the five relations are dealt once each, and a
source of any size is spread evenly. Sources are first aggregated where the rows lie.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habispark.llm.exact_dedup import text_key
from habispark.llm.tables import stored

LETTERS = "ABCDE"
_FEW_WORDS = 200


def failures(text: Column) -> dict[str, Column]:
    """Conditions A to D on a text that is not NULL."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    upper = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < _FEW_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": upper.cast("long") * 100 > F.length(text) * 2,
        "D": text.rlike("[#$%&*|]"),
    }


def failing_ids(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The rows (row_id, part, good, toxic) and, for each letter, the ids of those that fail the filter.

    Rows get ids of their own, since `doc_id` may be missing or repeated. All six tables are stored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text_key(text).alias("text_key"),
        *[failed.alias(letter) for letter, failed in failures(text).items()],
    )
    # Written once: the ids stay what they are, and texts are read once.
    read = stored(read, "audit-rows")
    # A document is good or toxic if any of its labels says so.
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = read.join(marks, F.col("doc_id") == F.col("labelled"), "left").select(
        "row_id", "part", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic")]
    )
    failing = {letter: read.filter(F.col(letter)).select("row_id") for letter in "ABCD"}
    # One row per text that occurs more than once; the rows of a very common one are split by adaptive execution.
    first = (
        read.groupBy(F.col("text_key").alias("copied"))
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )
    copies = read.select("row_id", "doc_id", "text_key").join(first, F.col("text_key") == F.col("copied"))
    failing["E"] = copies.filter(F.col("doc_id") > F.col("first_id")).select("row_id")
    return stored(rows, "audit-sources"), {letter: stored(ids, f"failing-{letter}") for letter, ids in failing.items()}


def _bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def survivors(rows: DataFrame, failing: Mapping[str, DataFrame]) -> DataFrame:
    """`rows` with the column `prefix`: a row is there once for every set of filters, out of `failing`, that leaves it."""
    rows = rows.withColumn("prefix", F.lit(0))
    for letter, ids in failing.items():
        both = rows.withColumn("taken", F.explode(F.array(F.lit(0), F.lit(_bit(letter)))))
        dropped = (F.col("row_id") == F.col("failed_id")) & (F.col("taken") > 0)
        left = both.join(ids.withColumnRenamed("row_id", "failed_id"), dropped, "left_anti")
        rows = left.withColumn("prefix", F.col("prefix") + F.col("taken")).drop("taken")
    return rows


def removals(rows: DataFrame, failing: Mapping[str, DataFrame]) -> DataFrame:
    """part, filter, prefix, removed, good_lost, toxic_lost: what each filter removes after each set of the others."""
    found = []
    for letter, ids in failing.items():
        caught = rows.join(ids, "row_id", "left_semi")
        left = survivors(caught, {other: f for other, f in failing.items() if other != letter})
        found.append(
            left.groupBy("part", "prefix")
            .agg(
                F.count(F.lit(1)).alias("removed"),
                F.sum("good").cast("long").alias("good_lost"),
                F.sum("toxic").cast("long").alias("toxic_lost"),
            )
            .select("part", F.lit(letter).alias("filter"), "prefix", "removed", "good_lost", "toxic_lost")
        )
    return reduce(DataFrame.unionByName, found)


def _orders(spark) -> DataFrame:
    """One row per order and step, with the filter of that step and the set of those before it: 600 rows."""
    steps = [
        ("".join(order), i + 1, letter, sum(map(_bit, order[:i])))
        for order in permutations(LETTERS)
        for i, letter in enumerate(order)
    ]
    return spark.createDataFrame(steps, "filter_order string, step int, filter string, prefix int")


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley, filter.

    Every part has a row for each of the 600 steps. A NULL text is empty and a NULL source the part ''; a
    text is judged whole, however long. Rows that repeat an identifier, or have none, are rows of their own;
    a row without an identifier is never later than another and hides none, so it does not fail E. Rows
    with the same identifier and text are no copies of each other. Labels that are NULL or belong to no
    row say nothing; of several labels of one identifier the highest counts. Other columns of both
    tables may have any name. An empty table of documents gives an empty result.
    """
    spark = docs.sparkSession
    rows, failing = failing_ids(docs, labels)
    kept = (
        survivors(rows, failing).groupBy("part", "prefix").agg(F.count(F.lit(1)).alias("kept"))
        .select(F.col("part").alias("kept_part"), F.col("prefix").alias("kept_prefix"), "kept")
    )
    # Read three times below: at most 80 rows of a part.
    gone = stored(removals(rows, failing), "audit-removals")
    size = F.bit_count("prefix")
    # The orders in which exactly these filters come before.
    orders = reduce(
        lambda rest, n: F.when(size == n, F.lit(factorial(n) * factorial(4 - n))).otherwise(rest), range(5), F.lit(0)
    )
    whole = gone.groupBy(F.col("part").alias("whole_part"), F.col("filter").alias("whole_filter")).agg(
        F.sum(F.when(F.col("prefix") == 0, F.col("removed"))).alias("fails"),
        F.sum(F.when(size == len(LETTERS) - 1, F.col("removed"))).alias("unique_fails"),
        F.sum(orders * F.col("removed")).alias("shapley"),
    )
    bits = F.array(*[F.lit(_bit(x)) for x in LETTERS])
    cells = (
        rows.select("part").distinct()
        .select("part", F.posexplode(bits).alias("index", "bit"))
        .select("part", F.substring(F.lit(LETTERS), F.col("index") + 1, F.lit(1)).alias("filter"), "bit",
                F.explode(F.sequence(F.lit(0), F.lit(31))).alias("prefix"))
        .filter(F.col("prefix").bitwiseAND(F.col("bit")) == 0)
    )
    cells = cells.join(gone, ["part", "filter", "prefix"], "left")
    cells = cells.join(whole, (F.col("part") == F.col("whole_part")) & (F.col("filter") == F.col("whole_filter")), "left")
    after = F.col("prefix") + F.col("bit")
    cells = cells.join(kept, (F.col("part") == F.col("kept_part")) & (after == F.col("kept_prefix")), "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    # 600 rows, whatever the tables.
    steps = F.broadcast(_orders(spark))
    return cells.join(steps, ["filter", "prefix"]).select(
        "part", "filter_order", "step", number("kept").alias("kept"), number("removed").alias("removed"),
        (number("fails") - number("removed")).alias("redundant"),
        *[number(c).alias(c) for c in ("unique_fails", "good_lost", "toxic_lost", "shapley")],
        "filter",
    )
