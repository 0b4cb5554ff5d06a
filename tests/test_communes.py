import pytest
from pyspark.sql import functions as F

from habispark.constants import CERTIFICATE_FIELDS, COMMUNE_COLUMNS
from habispark.operators import communes, numbering

COG = "TYPECOM string, COM string, REG string, DEP string, LIBELLE string, NCCENR string, COMPARENT string"


def cog(spark, *rows):
    return spark.createDataFrame([(k, c, r, d, n, n, None) for k, c, r, d, n in rows], COG)


def test_every_certificate_field_has_a_plain_name():
    for name in CERTIFICATE_FIELDS.values():
        assert name.isidentifier() and name == name.lower()
    assert len(set(CERTIFICATE_FIELDS.values())) == 12


@pytest.mark.parametrize(
    ("slugs", "unique"),
    [
        (["brest", "dole"], ["brest", "dole"]),
        (
            ["le-bourg", "le-bourg", "dole", "le-bourg", "le-bourg"],
            ["le-bourg", "le-bourg-1", "dole", "le-bourg-2", "le-bourg-3"],
        ),
        (["q", "r", "q", "s", "r"], ["q", "r", "q-1", "s", "r-1"]),
    ],
)
@pytest.mark.parametrize("slices", [1, 4096])
def test_slug_numbering(spark, monkeypatch, slugs, unique, slices):
    monkeypatch.setattr(numbering, "SLICES", slices)
    df = spark.createDataFrame(list(enumerate(slugs)), "o int, slug string")
    rows = numbering.deduplicate_slugs(df, [F.col("o")], F.col("o")).orderBy("o").collect()
    assert [r.slug for r in rows] == unique


def test_number_that_meets_a_natural_slug_is_reported(spark):
    df = spark.createDataFrame(list(enumerate(["a", "a", "a-1"])), "o int, slug string")
    numbered = numbering.deduplicate_slugs(df, [F.col("o")], F.col("o"))
    assert [tuple(r) for r in communes.duplicate_slugs(numbered).collect()] == [("a-1", 2)]


@pytest.mark.parametrize("slices", [1, 4096])
def test_build_communes(spark, monkeypatch, slices):
    monkeypatch.setattr(numbering, "SLICES", slices)
    rows = communes.build_communes(
        cog(
            spark,
            ("ARM", "69381", "84", "69", "Saint-Pierre"),
            ("COM", "97416", "04", "974", "Saint-Pierre"),
            ("COM", "2A004", "94", "2A", "Ajaccio"),
            ("COM", "14658", "28", "14", "Saint-Pierre"),
            ("COM", "99999", "99", "99", "Nulle part"),
            ("COM", "00000", None, None, "Sans rien"),
            ("COMD", "01001", "84", "01", "Ancienne"),
        )
    )
    assert tuple(rows.columns) == COMMUNE_COLUMNS
    found = {r.code_insee: r for r in rows.collect()}
    assert set(found) == {"69381", "97416", "2A004", "14658", "99999", "00000"}
    # Communes by code first, districts last.
    assert [found[c].slug for c in ("14658", "97416", "69381")] == [
        "saint-pierre", "saint-pierre-1", "saint-pierre-2",
    ]
    assert found["2A004"].nom_departement == "Corse-du-Sud" and found["2A004"].nom_region == "Corse"
    assert found["97416"].nom_departement == "La Réunion"
    assert found["99999"].nom_departement == "" and found["00000"].nom_region == ""
    assert found["2A004"].codes_postaux == "" and found["2A004"].population is None


def test_code_positions_follow_the_order_of_codes(spark):
    codes = ["", "0", "01001", "2A004", "2B033", "69381", "97416", "é", "\U0001f600", "ab", "abcdef", "abcdefg"]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    rows = df.select("c", communes.code_position(F.col("c")).alias("p")).orderBy("c").collect()
    places = [r.p for r in rows]
    assert places == sorted(places) and len(set(places)) == len(codes) - 1


def test_slugs_of_long_codes_that_begin_alike(spark):
    rows = [("COM", f"long-common-prefix-{i:05d}" if i % 3 else f"{i}", None, None, "Same") for i in range(600)] + [("ARM", None, None, None, "Same")]
    built = communes.build_communes(cog(spark, *rows).repartition(7)).collect()
    numbers = {r.code_insee: int(r.slug.removeprefix("same").removeprefix("-") or 0) for r in built}
    codes = sorted(c for c in numbers if c is not None)
    assert [numbers[c] for c in codes] == list(range(600)) and numbers[None] == 600


def test_first_non_null_is_per_column(spark):
    df = spark.createDataFrame(
        [("a", 1, None, "x"), ("a", 2, "5", None), ("a", 3, "6", "y"), ("b", 1, None, None)],
        "code_insee string, o int, latitude string, longitude string",
    )
    rows = communes.first_non_null(df, "code_insee", ["latitude", "longitude"], ["o"]).orderBy("code_insee")
    assert [tuple(r) for r in rows.collect()] == [("a", "5", "x"), ("b", None, None)]


def test_coordinates(spark):
    base = spark.createDataFrame(
        [("a", 1.0, 2.0), ("b", None, None), ("c", 7.0, None)], "code_insee string, latitude double, longitude double"
    )
    answers = spark.createDataFrame(
        [("a", "45.5", "abc", "a", 1), ("c", None, "3", "c", 2)],
        "code_insee string, latitude string, longitude string, result_citycode string, o int",
    )
    rows = communes.add_coordinates(base, answers, ["o"]).orderBy("code_insee").collect()
    assert [tuple(r) for r in rows] == [("a", 45.5, 2.0), ("b", None, None), ("c", 7.0, 3.0)]
    unusable = answers.drop("result_citycode")
    assert communes.add_coordinates(base, unusable, ["o"]) is base


def test_profile(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "slug string, latitude double")
    assert tuple(communes.communes_profile(df).first()) == (3, 2, 2)
