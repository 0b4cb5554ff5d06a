"""The four jobs of the data flow: sales, certificates, communes, and the published results."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from habispark.constants import (
    DEFAULT_YEARS,
    MIN_CERTIFICATES,
    MIN_SALES,
    PRICE_M2_BOUNDS,
    SAMPLE_ROWS,
)
from habispark.operators import aggregates, certificates, communes, coverage, restrict, sales
from habispark.operators.quality import QualityError, violations
from habispark.operators.skew import written
from habispark.sinks import discard, new_version, publish, read_published, stage, write_certificates, write_communes, write_sales
from habispark.sources import (
    landed_years,
    read_certificate_maps,
    read_cog,
    read_geocoded,
    read_sales,
    read_table,
)
from habispark.streaming.certificates import checked_certificates, scope_name

log = logging.getLogger("habispark")

# A deed id is unique within one published file, that is a year and, if split so, a département.
FILE_COLUMNS = ("annee_fichier", "departement")


def ingest_sales(
    spark: SparkSession,
    landing: str,
    target: str,
    years: Sequence[int] | None = None,
    department: str | None = None,
) -> DataFrame:
    """Cleans landed sales into the sales table; returns the funnel by file year and in total."""
    listed = landed_years(spark, landing)
    if years:
        absent = sorted(r.annee for r in restrict.missing_years(listed, years).collect())
        if absent:
            log.warning("requested years that are absent: %s", absent)
    else:
        years = [r.year for r in restrict.latest_values(listed, DEFAULT_YEARS).collect()]
    # Plain values, so that only the folders of these years are read.
    raw = restrict.sales_of_years(read_sales(spark, landing), years)
    if department is not None:
        folder = "departement" if "departement" in raw.columns else "code_departement"
        raw = raw.filter(F.col(folder) == department)
    # Compressed text is slow to read and not splittable: it is converted once, for three passes.
    rows = written(sales.with_numbers(raw), "sales")
    scope = [c for c in FILE_COLUMNS if c in rows.columns]
    write_sales(sales.clean_sales(rows, scope), target, rows)
    funnel = sales.sales_funnel_total(sales.sales_funnel(rows, ["annee_fichier"]), "annee_fichier")
    return funnel.withColumn("statut", sales.retention_status())


def ingest_certificates(
    spark: SparkSession,
    landing: str,
    target: str,
    postcode: str | None = None,
    everything: bool = False,
    multiline: bool = False,
) -> None:
    """Cleans landed certificate pages of one scope into the certificates table."""
    scope = scope_name(postcode, everything)
    rows = checked_certificates(read_certificate_maps(spark, landing, multiline), postcode)
    if rows is None:
        log.warning("no certificates below %s", landing)
        return
    write_certificates(rows, target, scope)


def ingest_communes(
    spark: SparkSession,
    cog_path: str,
    target: str,
    geocoded_path: str | None = None,
    department: str | None = None,
) -> DataFrame:
    """Builds the communes table and returns its profile, counted while it is written; raises before writing if
    slugs are not unique."""
    table = written(communes.build_communes(read_cog(spark, cog_path)), "communes")
    doubles = communes.duplicate_slugs(table).limit(SAMPLE_ROWS).collect()
    if doubles:
        raise QualityError(f"slugs that occur more than once: {[r.slug for r in doubles]}")
    if department is not None:
        table = restrict.communes_of_department(table, department)
    if geocoded_path is not None:
        try:
            answers = read_geocoded(spark, geocoded_path)
        except AnalysisException as error:
            # No batch came back: communes are published without coordinates.
            log.warning("no geocoder answers below %s: %s", geocoded_path, error.getCondition())
        else:
            table = communes.add_coordinates(table, answers, ["fichier", "position"])
    counts = Observation()
    write_communes(table, target, counts)
    # Slugs are known to be unique by now, so those of the written rows are as many as the rows that have one.
    found = counts.get
    profile = tuple(found[name] for name in ("communes", "slugs_uniques", "avec_coordonnees"))
    return spark.createDataFrame([profile], "communes long, slugs_uniques long, avec_coordonnees long")


def build_and_publish(
    sales_table: DataFrame,
    certificates_table: DataFrame,
    communes_table: DataFrame,
    target: str,
    department: str | None = None,
    min_sales: int = MIN_SALES,
    min_certificates: int = MIN_CERTIFICATES,
    price_bounds: tuple[float, float] = PRICE_M2_BOUNDS,
) -> DataFrame:
    """Builds, checks and publishes the four result tables; returns the coverage report.

    Every aggregate is computed once, into a new version folder; the coverage rule and the checks read its files.
    """
    spark = communes_table.sparkSession
    kept_sales, kept_certificates = sales_table, certificates_table
    if department is not None:
        kept_sales = restrict.sales_of_department(sales_table, department)
        kept_certificates = restrict.certificates_of_department(certificates_table, department)
    version = new_version(target)
    try:
        staged = {
            name: stage(table, f"{version}/{name}")
            for name, table in {
                "communes": communes_table,
                "agg_commune_immo": aggregates.commune_prices(kept_sales),
                "agg_commune_dpe": aggregates.commune_energy(kept_certificates),
            }.items()
        }
        prices, energy, known = staged["agg_commune_immo"], staged["agg_commune_dpe"], staged["communes"]
        eligible = coverage.eligible_communes(known, prices, energy, min_sales, min_certificates)
        stage(eligible.select("code_insee"), f"{version}/communes_eligible")
        publish(spark, version, violations(prices, energy, known, price_bounds))
    except Exception:
        discard(spark, version)
        raise
    return coverage_report(
        sales_table, certificates_table, known, read_published(spark, target, "communes_eligible"), department
    )


def publish_results(
    spark: SparkSession,
    sales_path: str,
    certificates_path: str,
    communes_path: str,
    target: str,
    department: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """`build_and_publish` over stored tables; `unique` counts a certificate of several scopes once."""
    stored = read_table(spark, certificates_path)
    return build_and_publish(
        read_table(spark, sales_path),
        certificates.unique_certificates(stored) if unique else stored,
        read_table(spark, communes_path),
        target,
        department,
    )


def coverage_report(
    sales_table: DataFrame,
    certificates_table: DataFrame,
    communes_table: DataFrame,
    eligible: DataFrame,
    department: str | None = None,
) -> DataFrame:
    """One row per measure (`mesure`) with its number of rows (`lignes`); each table is read once."""
    everything = F.lit(True)
    kept_sale = everything if department is None else restrict.sale_in_department(department)
    kept_certificate = everything if department is None else restrict.certificate_in_department(department)
    counted = (
        (sales_table, {"lignes_dvf": everything, "lignes_dvf_retenues": kept_sale}),
        (certificates_table, {"lignes_dpe": everything, "lignes_dpe_retenues": kept_certificate}),
        (communes_table, {"communes_total": everything}),
        (eligible, {"communes_eligibles": everything}),
    )
    rows = []
    for df, measures in counted:
        counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in measures.items()])
        pairs = [F.struct(F.lit(name).alias("mesure"), F.col(name).alias("lignes")) for name in measures]
        rows.append(counts.select(F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, rows)
