"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from habispark import sinks, sources, streaming
from habispark.constants import CERTIFICATE_FIELDS, DEPARTMENT_NAMES
from habispark.functions import (
    int_round,
    lenient_integer,
    lenient_number,
    normalize_null_tokens,
    parse_decimal_comma,
    price_per_m2,
    sale_year,
    slugify,
)
from habispark.operators import (
    aggregates,
    certificates,
    communes,
    coverage,
    numbering,
    quality,
    restrict,
    sales,
)
from habispark.plans import build_and_publish, coverage_report, ingest_certificates
from habispark.registry import standins as given
from habispark.session import scratch_dir

# Fixed values of the comparison, shared with the SQL: chosen so that each query both keeps and
# rejects rows of the given tables.
DEPARTMENT = "69"
POSTCODE = "80000"
COMMUNE_DEPARTMENT = "11"
LATEST = 5
REQUESTED_YEARS = (1990, 1996, 2030)
MIN_SALES, MIN_CERTIFICATES = 60, 45
PRICE_BOUNDS = (1000, 3000)
PUBLISHED_PRICE_BOUNDS = (1, 1_000_000)
SHARE_BOUNDS = (22, 28)
# Rounded shares miss the total by more than this in some communes.
SHARE_SLACK = 0.05
REWRITTEN_YEAR = 1996
PAGE_ROWS = 1000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _usable(spark, d):
    return sales.usable_sales(sales.with_numbers(given.sales(spark, d)))


def _clean(spark, d):
    return sales.clean_sales(given.sales(spark, d))


# --- sources -------------------------------------------------------------------------------------


@query
def src_sales_csv(spark, d):
    """Sales written as compressed CSV by year and département, then read back and parsed."""
    landing = scratch_dir(spark, "sales-csv")
    price = F.translate(F.col("valeur_fonciere").cast("string"), ".", ",")
    (
        given.sales(spark, d)
        .drop("id_voie", "dpe_numero")
        .withColumns(
            {
                "valeur_fonciere": price,
                "departement": F.concat(F.lit("0"), F.left("code_commune", F.lit(1))),
            }
        )
        .hint("rebalance", "annee_fichier", "departement")
        .write.partitionBy("annee_fichier", "departement")
        .option("header", True).option("compression", "gzip")
        .csv(landing)
    )
    return sales.with_numbers(sources.read_sales(spark, landing)).select(
        "id_mutation", "date_mutation", "nature_mutation", "type_local", "valeur_fonciere",
        "surface_reelle_bati", "code_commune", "code_departement", "id_parcelle",
        "annee_fichier", "departement",
    )


@query
def src_communes_csv(spark, d):
    landing = scratch_dir(spark, "cog-csv")
    given.cog(spark, d).write.option("header", True).csv(landing)
    return sources.read_cog(spark, landing).select("TYPECOM", "COM", "REG", "DEP", "LIBELLE", "COMPARENT")


@query
def src_sales_country_csv(spark, d):
    """Sales written as compressed CSV by year alone; the column `remarque` comes with one year only."""
    landing = scratch_dir(spark, "country-csv")
    rows = given.sales(spark, d).drop("id_voie", "dpe_numero")
    late = F.col("annee_fichier") == REWRITTEN_YEAR
    for part in (rows.filter(~late), rows.filter(late).withColumn("remarque", F.lit("a, \"b\"\nc"))):
        (
            part.hint("rebalance", "annee_fichier")
            .write.mode("append").partitionBy("annee_fichier")
            .options(header=True, compression="gzip", escape='"').csv(landing)
        )
    return sales.with_numbers(sources.read_sales(spark, landing)).select(
        "id_mutation", "valeur_fonciere", "code_commune", "annee_fichier", "remarque"
    )


@query
def src_geocoded_csv(spark, d):
    """Answers in batches, of which the first coordinate of each commune counts."""
    landing = scratch_dir(spark, "geocoded-csv")
    answers = given.geocoded(spark, d).repartitionByRange("ordre").sortWithinPartitions("ordre")
    answers.drop("ordre").write.option("header", True).csv(landing)
    return communes.first_non_null(
        sources.read_geocoded(spark, landing), "code_insee", ["latitude", "longitude"], ["fichier", "position"]
    )


def _certificate_pages(spark, d) -> str:
    landing = scratch_dir(spark, "certificate-pages")
    _pages(given.certificate_fields(spark, d)).write.json(landing)
    return landing


def _pages(rows: DataFrame) -> DataFrame:
    """Pages of about PAGE_ROWS rows of a class, as the service cuts them: none grows with the table."""
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    energy_class = F.col(next(f for f, name in CERTIFICATE_FIELDS.items() if name == "classe_dpe"))
    number = F.col(next(f for f, name in CERTIFICATE_FIELDS.items() if name == "numero_dpe"))
    # Certificate numbers count up, so a page takes as many as follow each other.
    slot = F.floor(number / PAGE_ROWS)
    pages = rows.groupBy(energy_class, slot).agg(F.collect_list(row).alias("results"))
    return pages.select("results", F.lit(None).cast("string").alias("next"))


@query
def src_certificates_json(spark, d):
    rows = certificates.rename_certificates(sources.read_certificates(spark, _certificate_pages(spark, d)))
    return rows.select(
        "numero_dpe", "code_postal", "code_insee", "classe_dpe", "annee_construction", "date_etablissement"
    )


@query
def src_parquet_glob(spark, d):
    """Two Parquet folders, one with a column more, read as one table."""
    root = scratch_dir(spark, "parquet")
    rows = given.certificates(spark, d).select("numero_dpe", "code_insee", "classe_dpe", "conso_energie")
    unlabelled = F.col("classe_dpe") == "N"
    rows.filter(unlabelled).withColumn("remarque", F.lit("sans classe")).write.parquet(f"{root}/part=1")
    rows.filter(~unlabelled).write.parquet(f"{root}/part=2")
    return sources.read_table(spark, root, ["numero_dpe", "code_insee"]).drop("part")


@query
def src_parquet_refused(spark, d):
    """Which of two Parquet folders has files without a needed column; their rows would be read as NULL."""
    root = scratch_dir(spark, "parquet")
    rows = given.certificates(spark, d).select("numero_dpe", "code_insee", "classe_dpe")
    unlabelled = F.col("classe_dpe") == "N"
    rows.filter(unlabelled).drop("code_insee").write.parquet(f"{root}/part=1")
    rows.filter(~unlabelled).write.parquet(f"{root}/part=2")
    lacking = sources.files_without(spark, root, ["numero_dpe", "code_insee", "part"])
    return lacking.select(F.regexp_extract("path", "part=([0-9]+)", 1).alias("partie"), F.col("column").alias("colonne")).distinct()


@query
def refused_inputs(spark, d):
    """Sales, pages and a commune list that lack a column are refused, and the error names it."""
    sold, listed = scratch_dir(spark, "sales-csv"), scratch_dir(spark, "cog-csv")
    pages, target = scratch_dir(spark, "certificate-pages"), scratch_dir(spark, "certificates-table")
    (
        given.sales(spark, d).drop("id_parcelle").hint("rebalance", "annee_fichier")
        .write.partitionBy("annee_fichier").options(header=True, compression="gzip").csv(sold)
    )
    given.cog(spark, d).drop("REG").write.option("header", True).csv(listed)
    greenhouse = next(f for f, name in CERTIFICATE_FIELDS.items() if name == "classe_ges")
    _pages(given.certificate_fields(spark, d).drop(greenhouse)).write.json(pages)
    attempts = {
        "ventes": lambda: sources.read_sales(spark, sold),
        "communes": lambda: sources.read_cog(spark, listed),
        "certificats": lambda: ingest_certificates(spark, pages, target, everything=True),
    }
    refused = []
    for name, attempt in attempts.items():
        try:
            attempt()
        except sources.SchemaError as error:
            refused += [(name, column) for column in error.missing]
    return spark.createDataFrame(refused, "entree string, colonne string")


@query
def latest_snapshot(spark, d):
    return sources.latest_snapshot(given.manifest(spark, d))


@query
def normalize_null_tokens_(spark, d):
    segment = F.col("c_mktsegment")
    text = (
        F.when(segment == "HOUSEHOLD", "NA").when(segment == "MACHINERY", "n/a")
        .when(segment == "FURNITURE", " NA ").when(segment == "BUILDING", "").otherwise(segment)
    )
    rows = given.table(spark, d, "customer").select("c_custkey", text.alias("segment"))
    return normalize_null_tokens(rows)


# --- sinks and jobs ------------------------------------------------------------------------------


def _attached_communes(spark, d):
    return given.communes(spark, d).fillna("inconnu", ["code_departement"])


@query
def publish_tables(spark, d):
    """The four tables built, checked and published, then all rows of what was published."""
    target = scratch_dir(spark, "published")
    _publish(spark, d, target, _attached_communes(spark, d), PUBLISHED_PRICE_BOUNDS)
    tables = [
        sinks.read_published(spark, target, name).select(F.lit(name).alias("nom_table"), "*")
        for name in sinks.tables.PUBLISHED
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables).drop("latitude", "longitude")


def _publish(spark, d, target, communes_table, bounds):
    build_and_publish(
        _clean(spark, d), given.certificates(spark, d), communes_table, target,
        min_sales=MIN_SALES, min_certificates=MIN_CERTIFICATES, price_bounds=bounds,
    )


@query
def publish_refused(spark, d):
    """Three publications: one that passes, then two that a check stops; what stopped them and what is still read."""
    target = scratch_dir(spark, "published")
    _publish(spark, d, target, _attached_communes(spark, d), PUBLISHED_PRICE_BOUNDS)
    stopped = []
    for table, bounds in ((_attached_communes(spark, d), PRICE_BOUNDS), (given.communes(spark, d), PUBLISHED_PRICE_BOUNDS)):
        try:
            _publish(spark, d, target, table, bounds)
        except quality.QualityError as error:
            stopped.append((error.check, error.rows))
    refused = spark.createDataFrame(stopped, "controle string, lignes long")
    left = sinks.read_published(spark, target, "agg_commune_immo").agg(F.count(F.lit(1)).alias("lignes"))
    return refused.unionByName(left.select(F.lit("publie").alias("controle"), "lignes"))


@query
def published_lookup(spark, d):
    """The published prices of the commune with the most rows, by its code."""
    target = scratch_dir(spark, "published")
    _publish(spark, d, target, _attached_communes(spark, d), PUBLISHED_PRICE_BOUNDS)
    per_commune = sinks.read_published(spark, target, "agg_commune_immo").groupBy("code_insee").count()
    code = per_commune.orderBy(F.col("count").desc(), "code_insee").first()["code_insee"]
    return sinks.published_rows(spark, target, "agg_commune_immo", code)


@query
def certificates_stream(spark, d):
    """Pages that land in two instalments, each followed by a run of the stream."""
    landing, target = scratch_dir(spark, "pages"), scratch_dir(spark, "stream")
    checkpoints = scratch_dir(spark, "stream-state")
    pages = _pages(given.certificate_fields(spark, d))
    field = next(f for f, name in CERTIFICATE_FIELDS.items() if name == "classe_dpe")
    early = F.col("results")[0][field].isin("A", "C")
    for arrived in (early, ~early):
        pages.filter(arrived).write.mode("append").json(landing)
        streaming.ingest_new_certificates(spark, landing, target, checkpoints, everything=True)
    return sources.read_table(spark, target).drop("perimetre", "lot")


@query
def write_sales_twice(spark, d):
    """All sales, then one year again of which only houses are left."""
    target, rows = scratch_dir(spark, "sales-table"), _clean(spark, d).drop("dpe_numero")
    sinks.write_sales(rows, target)
    again = rows.filter(F.col("annee_fichier") == REWRITTEN_YEAR)
    sinks.write_sales(again.filter(F.col("type_local") == "Maison"), target, again)
    return sources.read_table(spark, target).select(
        "id_mutation", "id_parcelle", "type_local", "code_departement", "annee_fichier"
    )


@query
def write_certificates_scopes(spark, d):
    """Two scopes that overlap, each certificate once."""
    target, rows = scratch_dir(spark, "certificates-table"), given.certificates(spark, d)
    sinks.write_certificates(rows, target, "full")
    sinks.write_certificates(restrict.certificates_of_postcode(rows, POSTCODE), target, POSTCODE)
    return certificates.unique_certificates(sources.read_table(spark, target)).select(
        "numero_dpe", "code_postal", "code_insee", "classe_dpe", "conso_energie"
    )


@query
def write_communes_table(spark, d):
    target = scratch_dir(spark, "communes-table")
    sinks.write_communes(given.communes(spark, d), target)
    return sources.read_table(spark, target).select("code_insee", "nom", "code_departement")


@query
def coverage_report_(spark, d):
    return coverage_report(
        _clean(spark, d), given.certificates(spark, d), given.communes(spark, d), eligible_communes(spark, d), DEPARTMENT
    )


# --- scalar expressions --------------------------------------------------------------------------


@query
def certificates_rename(spark, d):
    return certificates.rename_certificates(given.certificate_fields(spark, d))


@query
def clean_certificates(spark, d):
    return certificates.clean_certificates(given.certificate_fields(spark, d))


@query
def parse_decimal_comma_(spark, d):
    text = F.translate(F.col("l_extendedprice").cast("string"), ".", ",")
    return given.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", parse_decimal_comma(text).alias("prix")
    )


@query
def lenient_numeric(spark, d):
    kind, text = F.col("event_type"), F.col("value").cast("string")
    cell = (
        F.when(kind == "click", F.concat(text, F.lit("d"))).when(kind == "error", "abc")
        .when(kind == "purchase", "1e400").when(kind == "signup", F.concat(F.lit(" "), text, F.lit(" ")))
        .otherwise(text)
    )
    return given.table(spark, d, "events").select("event_id", lenient_number(cell).alias("v"))


@query
def lenient_integer_(spark, d):
    year = F.year("o_orderdate").cast("string")
    cell = F.when(F.col("o_orderstatus") == "P", "inconnue").when(
        F.col("o_orderstatus") == "F", F.concat(year, F.lit(".0"))
    ).otherwise(year)
    return given.table(spark, d, "orders").select("o_orderkey", lenient_integer(cell).alias("annee"))


@query
def price_per_m2_(spark, d):
    rows = _clean(spark, d).filter(F.col("surface_reelle_bati") > 0)
    return rows.select("id_mutation", "id_parcelle", price_per_m2().alias("prix_m2"))


@query
def sale_year_(spark, d):
    return _clean(spark, d).select("id_mutation", sale_year().alias("annee"))


@query
def int_round_(spark, d):
    half = F.col("l_quantity") / 2
    return given.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", int_round(half).alias("half_even")
    )


@query
def dim_lookup(spark, d):
    rows = given.table(spark, d, "customer").select(
        "c_custkey", given.department_of("c_custkey").alias("code_departement")
    )
    return communes.lookup_name(rows, DEPARTMENT_NAMES, "code_departement", "nom_departement")


@query
def slugify_(spark, d):
    return given.table(spark, d, "documents").select("doc_id", slugify(F.col("text")).alias("slug"))


# --- filters -------------------------------------------------------------------------------------


@query
def usable_sales(spark, d):
    return _usable(spark, d).select(
        "id_mutation", "id_parcelle", "type_local", "valeur_fonciere", "surface_reelle_bati"
    )


@query
def sales_by_dept(spark, d):
    return restrict.sales_of_department(given.sales(spark, d), DEPARTMENT).select(
        "id_mutation", "id_parcelle", "code_departement"
    )


@query
def certificates_by_dept(spark, d):
    return restrict.certificates_of_department(given.certificates(spark, d), DEPARTMENT).select(
        "numero_dpe", "code_insee"
    )


@query
def certificates_by_postcode(spark, d):
    return restrict.certificates_of_postcode(given.certificates(spark, d), POSTCODE).select(
        "numero_dpe", "code_postal"
    )


@query
def communes_by_dept(spark, d):
    built = communes.build_communes(given.cog(spark, d))
    return restrict.communes_of_department(built, COMMUNE_DEPARTMENT).select(
        "code_insee", "slug", "code_departement", "nom_departement"
    )


@query
def sales_last_n_years(spark, d):
    """Sales stored by year, then the latest years of the stored table."""
    target = scratch_dir(spark, "sales-by-year")
    rows = given.sales(spark, d).select("id_mutation", "id_parcelle", "annee_fichier")
    rows.hint("rebalance", "annee_fichier").write.partitionBy("annee_fichier").parquet(target)
    return restrict.latest_stored_years(spark, target, LATEST)


@query
def missing_years(spark, d):
    return restrict.missing_years(given.sales(spark, d), REQUESTED_YEARS)


# --- sales ---------------------------------------------------------------------------------------


@query
def multi_parcel_deeds(spark, d):
    return sales.multi_parcel_deeds(_usable(spark, d))


@query
def single_parcel_sales(spark, d):
    return sales.single_parcel_sales(_usable(spark, d)).select(
        "id_mutation", "id_parcelle", "type_local", "valeur_fonciere"
    )


@query
def clean_sales(spark, d):
    return _clean(spark, d).drop("dpe_numero")


@query
def sales_funnel(spark, d):
    return sales.sales_funnel(given.sales(spark, d))


@query
def sales_funnel_total(spark, d):
    by_year = sales.sales_funnel(given.sales(spark, d), ["annee_fichier"])
    return sales.sales_funnel_total(by_year, "annee_fichier")


@query
def check_retention_band(spark, d):
    return sales.sales_funnel(given.sales(spark, d)).select(
        "taux_retention_pct", sales.retention_status().alias("statut")
    )


# --- aggregates ----------------------------------------------------------------------------------


@query
def agg_commune_immo(spark, d):
    return aggregates.commune_prices(_clean(spark, d))


@query
def agg_commune_dpe(spark, d):
    return aggregates.commune_energy(given.certificates(spark, d))


@query
def agg_street(spark, d):
    return aggregates.street_prices(_clean(spark, d))


@query
def price_by_energy_class(spark, d):
    return aggregates.prices_by_energy_class(_clean(spark, d), given.certificates(spark, d))


@query
def eligible_communes(spark, d):
    return coverage.eligible_communes(
        given.communes(spark, d),
        aggregates.sale_counts(_clean(spark, d)),
        aggregates.commune_energy(given.certificates(spark, d)),
        MIN_SALES,
        MIN_CERTIFICATES,
    )


# --- communes ------------------------------------------------------------------------------------


@query
def communes_union_districts(spark, d):
    return communes.communes_and_districts(given.cog(spark, d)).select("TYPECOM", "COM", "LIBELLE")


@query
def dedupe_slugs(spark, d):
    rows = given.table(spark, d, "part").select("p_partkey", slugify(F.col("p_name")).alias("slug"))
    return numbering.deduplicate_slugs(rows, [F.col("p_partkey")], F.col("p_partkey"))


@query
def communes_build(spark, d):
    return communes.build_communes(given.cog(spark, d))


@query
def first_non_null(spark, d):
    return communes.first_non_null(
        given.geocoded(spark, d), "code_insee", ["latitude", "longitude"], ["ordre"]
    )


@query
def commune_coordinates(spark, d):
    return communes.add_coordinates(given.communes(spark, d), given.geocoded(spark, d), ["ordre"])


@query
def communes_profile(spark, d):
    built = communes.build_communes(given.cog(spark, d))
    return communes.communes_profile(communes.add_coordinates(built, given.geocoded(spark, d), ["ordre"]))


@query
def check_slug_unique(spark, d):
    """Slugs before numbering, so that there are duplicates to find."""
    return communes.duplicate_slugs(
        given.table(spark, d, "part").select(slugify(F.col("p_name")).alias("slug"))
    )


# --- quality checks ------------------------------------------------------------------------------


@query
def check_price_bounds(spark, d):
    return quality.price_out_of_bounds(agg_commune_immo(spark, d), PRICE_BOUNDS)


@query
def check_share_bounds(spark, d):
    return quality.share_out_of_bounds(agg_commune_dpe(spark, d), SHARE_BOUNDS)


@query
def check_share_sum(spark, d):
    off = quality.share_total_off(agg_commune_dpe(spark, d), tolerance=SHARE_SLACK)
    return off.withColumn("total", F.round("total", 1))


@query
def orphan_communes(spark, d):
    return quality.communes_without_department(agg_commune_immo(spark, d), given.communes(spark, d))


@query
def check_samples(spark, d):
    """The first offenders of two checks, and how many there are."""
    prices = agg_commune_immo(spark, d)
    return quality.offender_samples(
        {
            "prix_m2_bornes": quality.price_out_of_bounds(prices, PRICE_BOUNDS),
            "communes_departement": quality.communes_without_department(prices, given.communes(spark, d)),
        }
    )


@query
def quality_report(spark, d):
    return quality.quality_counts(agg_commune_immo(spark, d), agg_commune_dpe(spark, d), given.communes(spark, d))


# A trailing underscore only keeps a query apart from the function it calls.
QUERIES = {name.removesuffix("_"): function for name, function in QUERIES.items()}
