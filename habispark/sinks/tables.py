"""Parquet tables between the steps, and the published result tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from habispark import commits
from habispark.operators.communes import code_position
from habispark.operators.quality import require_no_violation
from habispark.operators.skew import slot_of
from habispark.sources import read_table

PUBLISHED = ("communes", "agg_commune_immo", "agg_commune_dpe", "communes_eligible")
# Folder beside the certificates with the ranges of codes of their files; readers of the table skip it.
RANGES = "_ranges"
# Steps of the curve along each code: a power of two.
CURVE_STEPS = 256
# Distinct communes of a file for which its Bloom filter stays exact to about one in a hundred.
FILE_COMMUNES = 50_000
# Written last: a version without it was not published.
MARK = "_PUBLISHED"
KEPT_VERSIONS = 2


def _replace(df: DataFrame, path: str, columns: list[str], gone: Callable[[], Iterable[str]] = tuple) -> None:
    """Replaces the partitions present in `df`, and drops those that `gone` names, all at once.

    A large partition is split over several files.
    """
    spark = df.sparkSession
    number = commits.next_generation(spark, path)
    folder = f"{commits.GENERATION}={number}"
    rows = df.hint("rebalance", *columns) if columns else df
    writer = rows.write.partitionBy(*columns) if columns else rows.write
    writer.parquet(f"{path}/{folder}")
    below = "/".join(f"{c}=*" for c in columns)
    new = [found.split(f"/{folder}/", 1)[1] for found in commits.matching(spark, f"{path}/{folder}/{below}")] if columns else [""]
    replaced = {*new, *gone()}
    before = commits.live_folders(spark, path) or []
    stay = [f for f in before if f.split("/", 1)[-1] not in replaced] if columns else []
    commits.commit(spark, path, number, [*stay, *[f"{folder}/{n}".rstrip("/") for n in new]])


def write_sales(sales: DataFrame, path: str, landed: DataFrame | None = None) -> None:
    """Clean sales by landed file: year and landed département, or for country files the row's own.

    What the files in `landed` (raw rows, `sales` by default) produced before is replaced, also where nothing
    of them is left now, and readers see it happen at once; other files of the same year stay. A table is laid out in one of the two ways: a
    folder that already holds the other one is refused.
    """
    place = "departement" if "departement" in sales.columns else "code_departement"
    columns = ["annee_fichier", place]
    spark = sales.sparkSession
    present = commits.live_folders(spark, path) or []
    if any(not folder.rsplit("/", 1)[1].startswith(f"{place}=") for folder in present):
        raise ValueError(f"{path} holds the other kind of sales files, département or country")

    def landed_folders() -> Iterable[str]:
        if landed is None:
            return
        # One row per landed file, or per département of a country file.
        for row in landed.select(*columns).distinct().collect():
            year, code = ("__HIVE_DEFAULT_PARTITION__" if v is None else v for v in row)
            yield f"annee_fichier={year}/{place}={code}"

    _replace(sales, path, columns, landed_folders)


def write_certificates(certificates: DataFrame, path: str, scope: str, lot: str = "pages") -> None:
    """Clean certificates of one scope (a postal code, or 'full') and one lot of its pages.

    Replaces what the lot held before, so that a lot may be written again; the lot 'pages' stands for all pages of
    the scope and replaces all its lots. Files are cut along a curve through both codes (`along_curve`), and the
    range of codes in each file is kept beside the table, so `certificates_of` opens few of them.
    """
    spark = certificates.sparkSession
    folder = f"{path}/perimetre={scope}"
    along_curve(certificates, "code_postal", "code_insee").write.mode("overwrite").parquet(f"{folder}/lot={lot}")
    _write_ranges(spark, path, scope, lot)
    if lot == "pages":
        for other in commits.matching(spark, f"{folder}/lot=*"):
            if not other.endswith("/lot=pages"):
                commits.drop(spark, f"{path}/{RANGES}/perimetre={scope}/{other.rsplit('/', 1)[1]}")
                commits.drop(spark, other)


def along_curve(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows dealt and sorted along a Z-shaped curve through two codes, in ranges of rows as even as a shuffle makes them.

    A code is placed among 256 even steps of its column, so that both columns cut the table evenly whatever their
    alphabets. Rows of one code are dealt further by a hash of the row: a code may fill several files.
    """
    codes = (first, second)
    steps = F.array(*[F.lit(i / CURVE_STEPS) for i in range(1, CURVE_STEPS)])
    cuts = df.agg(*[F.percentile_approx(code_position(F.col(c)), steps, CURVE_STEPS * 20).alias(c) for c in codes]).first()
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    placed, curve = df.withColumn("_row", row), F.lit(0)
    for i, c in enumerate(codes):
        edges = F.array(*[F.lit(float(x)) for x in cuts[i] or [0.0] * (CURVE_STEPS - 1)])
        placed = placed.withColumns({f"_cuts_{i}": edges, f"_at_{i}": code_position(F.col(c))})
        placed = placed.withColumn(f"_slot_{i}", slot_of(f"_cuts_{i}", f"_at_{i}", CURVE_STEPS)).drop(f"_cuts_{i}", f"_at_{i}")
        for bit in range(CURVE_STEPS.bit_length() - 1):
            one = F.shiftright(F.col(f"_slot_{i}"), bit).bitwiseAND(1)
            curve = curve + F.shiftleft(one, 2 * bit + 1 - i)
    order = ["_curve", *codes, "_row"]
    placed = placed.withColumn("_curve", curve).select(*df.columns, "_curve", "_row")
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select(*df.columns)


def _write_ranges(spark: SparkSession, path: str, scope: str, lot: str) -> None:
    """Least and greatest codes of each file of a lot, and whether it has rows without one."""
    rows = spark.read.parquet(f"{path}/perimetre={scope}/lot={lot}")
    ends = [
        f(F.col(c)).alias(f"{name}_{c}") for c in ("code_postal", "code_insee") for name, f in (("least", F.min), ("greatest", F.max))
    ]
    files = rows.groupBy(F.col("_metadata.file_name").alias("fichier")).agg(F.count(F.lit(1)).alias("lignes"), *ends)
    files.coalesce(1).write.mode("overwrite").parquet(f"{path}/{RANGES}/perimetre={scope}/lot={lot}")


def certificates_of(spark: SparkSession, path: str, column: str, code: str) -> DataFrame:
    """Certificates whose `code_postal` or `code_insee` is `code`, of all scopes and lots.

    Only files whose range of codes holds it are opened. The names of those come to the driver, as the names
    of all files do in any other read.
    """
    ranges = read_table(spark, f"{path}/{RANGES}")
    held = ranges.filter((F.col(f"least_{column}") <= code) & (F.col(f"greatest_{column}") >= code))
    files = [f"{path}/perimetre={r.perimetre}/lot={r.lot}/{r.fichier}" for r in held.select("perimetre", "lot", "fichier").collect()]
    schema = read_table(spark, path).schema
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*files).filter(F.col(column) == code)


def write_communes(communes: DataFrame, path: str, counts: Observation | None = None) -> None:
    """The communes table; `counts` gets its rows, slugs and coordinates, as the last tasks see them."""
    rows = _sorted_by_commune(communes)
    if counts is not None:
        # Behind the shuffle: what a task repeats is counted once there.
        rows = rows.observe(
            counts,
            F.count(F.lit(1)).alias("communes"),
            F.count("slug").alias("slugs_uniques"),
            F.count("latitude").alias("avec_coordonnees"),
        )
    _replace(rows, path, [])


def _sorted_by_commune(df: DataFrame) -> DataFrame:
    """Sorted files, so that row-group statistics serve lookups by commune. Dealt by hash: a range would be
    sampled first, and the frame computed twice."""
    return df.repartition("code_insee").sortWithinPartitions("code_insee")


def stage(df: DataFrame, path: str) -> DataFrame:
    """Writes a result table and reads it back, so that later steps use what was written.

    Every file has a Bloom filter of its communes beside the usual statistics: the files share all ranges of
    communes, as they are dealt by hash, and a commune lies in one of them only.
    """
    writer = _sorted_by_commune(df).write.mode("overwrite")
    for option, value in (("enabled", "true"), ("expected.ndv", str(FILE_COMMUNES))):
        writer = writer.option(f"parquet.bloom.filter.{option}#code_insee", value)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def new_version(target: str) -> str:
    """A folder for the next version of the published tables; later ones have greater names."""
    return f"{target}/version-{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, version: str, checks: Mapping[str, DataFrame]) -> None:
    """Publishes the tables written below `version`, all at once, unless one of the checks finds rows.

    One empty file, written last, makes the version count; readers see the one before until then. The last
    KEPT_VERSIONS published versions stay, for reads that have begun.
    """
    require_no_violation(checks)
    commits.file_system(spark, version).create(commits.hadoop_path(spark, f"{version}/{MARK}"), True).close()
    target = version.rsplit("/", 1)[0]
    for old in commits.matching(spark, f"{target}/version-*/{MARK}")[:-KEPT_VERSIONS]:
        commits.drop(spark, old.rsplit("/", 1)[0])


def discard(spark: SparkSession, version: str) -> None:
    """Deletes a version that was not published."""
    commits.drop(spark, version)


def published_rows(spark: SparkSession, target: str, name: str, code_insee: str) -> DataFrame:
    """The rows of one commune of a published table; row groups that cannot hold it are not read."""
    return read_published(spark, target, name).filter(F.col("code_insee") == code_insee)


def read_published(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A table of the version published last."""
    versions = commits.matching(spark, f"{target}/version-*/{MARK}")
    if not versions:
        raise LookupError(f"nothing is published below {target}")
    return spark.read.parquet(f"{versions[-1].rsplit('/', 1)[0]}/{name}")
