"""Tables between the steps of one operator."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from habispark.session import scratch_dir

# Parts of a dealt table: each is one task of the passes over it.
MOST_PARTS = 10_000


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes the frame below `spark.checkpoint.dir` and reads it back, which also cuts lineage."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_at(df: DataFrame, label: str, *by: str) -> tuple[DataFrame, str]:
    """`stored`, in folders by the columns `by`, and where it lies, so that it can be discarded."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder of scratch rows. Only for rows that nothing reads any more, a repeated task included: what was
    made of them must be stored itself."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def dealt(df: DataFrame, label: str, key: str, count: int) -> DataFrame:
    """Like `stored`, in at most `count` parts by the hash of `key`: grouping by `key` then moves none of its rows."""
    spark, name = df.sparkSession, f"dealt_{uuid.uuid4().hex}"
    writer = df.write.option("path", scratch_dir(spark, label)).option("compression", "zstd")
    writer.bucketBy(max(1, min(count, MOST_PARTS)), key).saveAsTable(name)
    table = spark.table(name)
    # Only the name goes: the files lie where the path says, and the frame knows how they are dealt.
    spark.sql(f"DROP TABLE {name}")
    return table


def partitions(df: DataFrame) -> int:
    """Into how many tasks Spark cuts the frame; plans it, computes nothing."""
    return max(1, df.rdd.getNumPartitions())


def lower_ascii(text: Column) -> Column:
    """A-Z only; NULL counts as empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def unused(name: str, columns: list[str]) -> str:
    """A column name like `name` that is not among `columns`, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without_rows(docs: DataFrame, keys: list[Column], dropped: DataFrame) -> DataFrame:
    """The rows of `docs` whose `keys` are together no row of `dropped`; a NULL equals a NULL."""
    own, names = [], []
    for i in range(len(keys)):
        own.append(unused(f"own_key_{i}", docs.columns))
        names.append(unused(f"dropped_key_{i}", docs.columns))
    # Columns of their own, so that the join does not work the keys out again and again while it sorts.
    keyed = docs.select("*", *[k.alias(n) for k, n in zip(keys, own, strict=True)])
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(own, names, strict=True)]
    return keyed.join(dropped.toDF(*names).distinct(), same, "left_anti").drop(*own)


def read_table(spark, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
