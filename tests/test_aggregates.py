import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql
from habispark.functions import exact_mean
from habispark.operators import aggregates, coverage, quality
from habispark.registry import standins
from tests.compare import differences


def sales(spark, rows):
    return spark.createDataFrame(
        rows,
        "code_commune string, date_mutation string, type_local string, valeur_fonciere double, "
        "surface_reelle_bati double, id_voie string",
    )


def test_commune_prices(spark):
    df = sales(
        spark,
        [
            ("69381", "2023-01-01", "Maison", 100000.0, 50.0, "v1"),
            ("69381", "2023-06-01", "Maison", 200001.0, 100.0, "v1"),
            ("69381", "2024-06-01", "Maison", 5.0, 10.0, None),
            ("69381", "2024-06-01", "Maison", 9.0, 0.0, "v2"),
            (None, "2024-06-01", "Maison", 30.0, 20.0, "v2"),
        ],
    )
    rows = {(r.code_insee, r.annee): r for r in aggregates.commune_prices(df).collect()}
    assert set(rows) == {("69381", 2023), ("69381", 2024), (None, 2024)}
    first = rows["69381", 2023]
    # 150000.5 and its like are rounded to the even neighbour.
    assert (first.nb_ventes, first.prix_median, first.surface_mediane) == (2, 150000, 75)
    assert (first.prix_m2_median, first.prix_m2_p25, first.prix_m2_p75) == (2000, 2000, 2000)
    assert rows["69381", 2024].prix_m2_median == 0
    assert rows[None, 2024].prix_m2_median == 2
    streets = {r.id_voie: r for r in aggregates.street_prices(df).collect()}
    assert set(streets) == {"v1", "v2"}
    assert (streets["v1"].nb_ventes, str(streets["v1"].derniere_vente)) == (2, "2023-06-01")
    counts = {r.code_insee: r.nb_ventes for r in aggregates.sale_counts(df).collect()}
    assert counts == {"69381": 3, None: 1}


def test_malformed_date_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        aggregates.commune_prices(sales(spark, [("1", "01/02/2024", "Maison", 1.0, 10.0, "v")])).collect()


def certificates(spark, rows):
    return spark.createDataFrame(rows, "code_insee string, classe_dpe string, conso_energie double")


def test_commune_energy(spark):
    df = certificates(
        spark,
        [("1", "A", 10.0), ("1", "A", None), ("1", "G", 30.04), ("1", "N", 9.0), ("1", None, 9.0), ("", "A", 1.0),
         (None, "A", 1.0), ("2", "B", None)],
    )
    rows = {(r.code_insee, r.classe_dpe): r for r in aggregates.commune_energy(df).collect()}
    assert set(rows) == {("1", "A"), ("1", "G"), ("2", "B")}
    assert (rows["1", "A"].nb_logements, rows["1", "A"].part_pct, rows["1", "A"].conso_moyenne) == (2, 66.7, 10.0)
    assert (rows["1", "G"].part_pct, rows["1", "G"].conso_moyenne) == (33.3, 30.0)
    assert (rows["2", "B"].part_pct, rows["2", "B"].conso_moyenne) == (100.0, None)
    assert dict(aggregates.commune_energy(df).dtypes)["part_pct"] == "double"


def test_means_are_exact_whatever_the_order(spark):
    """Sums of doubles would put some of these means on either side of the half."""
    rng = random.Random(9)
    groups = {f"g{k}": [round(rng.uniform(-90, 900), rng.choice([1, 2, 4])) for _ in range(rng.choice([1, 2, 20, 40]))] for k in range(300)}
    groups |= {"tie": [40.1, 40.6], "below": [-40.1, -40.6], "third": [1e15 + 0.5, 0.25, 0.125], "none": [None, None], "one": [0.1, None]}
    rows = [(k, v) for k, values in groups.items() for v in values]
    right = {}
    for k, values in groups.items():
        present = [Decimal(repr(v)) for v in values if v is not None]
        exact = sum(Fraction(v) for v in present) / len(present) if present else None
        right[k] = None if exact is None else float(Decimal(exact.numerator).__truediv__(exact.denominator).quantize(Decimal("0.1"), ROUND_HALF_UP))
    for parts in (1, 3, 8):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
        assert {r.k: r.m for r in df.groupBy("k").agg(exact_mean(F.col("v"), 1).alias("m")).collect()} == right
    with pytest.raises(Exception, match="too large"):
        spark.createDataFrame([(1e30,)], "v double").agg(exact_mean(F.col("v"), 1)).collect()


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_energy_equals_its_sql_under_any_partitioning(spark, size):
    folder = f"/root/testdata/{size}"
    sql = oracle_sql()["agg_commune_dpe"]
    for split in (lambda df: df.coalesce(1), lambda df: df.repartition(5), lambda df: df.repartition(9, "classe_dpe")):
        assert differences(spark, folder, "agg_commune_dpe", lambda s, d: aggregates.commune_energy(split(standins.certificates(s, d))), sql) == []


def test_coverage_rule(spark):
    communes = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C"), ("d", "D")], "code_insee string, nom string")
    prices = spark.createDataFrame([("a", 7), ("a", 8), ("b", 14), ("c", 99)], "code_insee string, nb_ventes int")
    energy = spark.createDataFrame([("a", 4), ("a", 6), ("b", 10), ("c", 9)], "code_insee string, nb_logements int")
    assert [tuple(r) for r in coverage.eligible_communes(communes, prices, energy).collect()] == [("a", "A")]


@pytest.fixture
def results(spark):
    prices = spark.createDataFrame(
        [("a", 2024, "Maison", 2000), ("b", 2024, "Maison", None)],
        "code_insee string, annee int, type_local string, prix_m2_median int",
    )
    energy = spark.createDataFrame(
        [("a", "A", 66.7), ("a", "B", 33.3), ("b", "A", 100.0)], "code_insee string, classe_dpe string, part_pct double"
    )
    communes = spark.createDataFrame(
        [("a", "69"), ("b", "01"), ("c", None)], "code_insee string, code_departement string"
    )
    return prices, energy, communes


def test_checks_pass(results):
    checks = quality.violations(*results)
    quality.require_no_violation(checks)
    assert {(r.lignes, r.statut) for r in quality.quality_report(checks).collect()} == {(0, "ok")}


@pytest.mark.parametrize(
    ("table", "row", "check"),
    [
        (0, ("a", 2024, "Maison", 99), "prix_m2_bornes"),
        (0, ("a", 2024, "Maison", 40001), "prix_m2_bornes"),
        (0, ("c", 2024, "Maison", 500), "communes_departement"),
        (0, ("z", 2024, "Maison", 500), "communes_departement"),
        (0, (None, 2024, "Maison", 500), "communes_departement"),
        (1, ("d", "A", 100.1), "part_pct_bornes"),
        (1, ("d", "A", 99.4), "part_pct_somme"),
    ],
)
def test_each_check_fails(spark, results, table, row, check):
    tables = list(results)
    tables[table] = tables[table].union(spark.createDataFrame([row], tables[table].schema))
    checks = quality.violations(*tables)
    with pytest.raises(quality.QualityError, match=check):
        quality.require_no_violation(checks)
    failing = {r.controle for r in quality.quality_report(checks).filter(F.col("statut") == "ko").collect()}
    assert failing == {check}


def test_the_first_failing_check_is_reported(spark, results):
    prices, energy, communes = results
    bad_prices = prices.union(spark.createDataFrame([("z", 2024, "Maison", 1)], prices.schema))
    bad_energy = energy.union(spark.createDataFrame([("d", "A", -1.0)], energy.schema))
    with pytest.raises(quality.QualityError, match="prix_m2_bornes: 1 rows"):
        quality.require_no_violation(quality.violations(bad_prices, bad_energy, communes))
