"""How much of a written table a lookup by code reads."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from habispark import sinks, sources
from habispark.operators import quality
from habispark.registry import standins

SMALL = "/root/testdata/sf0.01"


def scanned(df) -> tuple[int, int]:
    """Rows that the scan of a frame gives on, and files it opens, as Spark measures them; runs the frame."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().apply(0)
    while leaf.getClass().getSimpleName() in ("QueryStage", "ShuffleQueryStageExec", "AdaptiveSparkPlanExec"):
        leaf = leaf.executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value(), leaf.metrics().apply("numFiles").value()


@pytest.fixture
def many_files(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def certificates(spark):
    """20,000 certificates of 1,000 postal codes, a third of them in one; a postal code has a few communes."""
    place = F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") * 7919 % 1000)
    rows = spark.range(20_000).withColumn("place", place)
    return rows.select(
        F.col("id").cast("string").alias("numero_dpe"),
        F.when(F.col("id") % 997 != 0, F.format_string("%05d", F.col("place") * 97)).alias("code_postal"),
        F.when(F.col("id") % 991 != 0, F.format_string("%05d", F.col("place") * 97 + F.col("id") % 4)).alias("code_insee"),
        F.col("id").cast("double").alias("conso_energie"),
    )


def test_a_postal_code_opens_few_files(spark, tmp_path, many_files):
    rows, out = certificates(spark), str(tmp_path)
    sinks.write_certificates(rows, out, "full")
    files = list((tmp_path / "perimetre=full" / "lot=pages").glob("*.parquet"))
    assert len(files) >= 45
    for column in ("code_postal", "code_insee"):
        for code in ("00970", "48597", "90000"):
            found = sinks.certificates_of(spark, out, column, code)
            right = rows.filter(F.col(column) == code)
            assert sorted(r.numero_dpe for r in found.collect()) == sorted(r.numero_dpe for r in right.collect())
            if right.count():
                assert scanned(found)[1] < len(files) / 10
    # The frequent code is spread over many files all the same: no file holds more than a small share.
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files]
    assert sum(sizes) == 20_000 and max(sizes) < 2_000
    assert len(sinks.certificates_of(spark, out, "code_postal", "48500").inputFiles()) > 5
    assert sources.read_table(spark, out).count() == 20_000


def test_lookups_follow_rewritten_lots_and_scopes(spark, tmp_path):
    rows, out = certificates(spark), str(tmp_path)
    sinks.write_certificates(rows.limit(50), out, "full", "flux-00000001")
    sinks.write_certificates(rows.filter("code_postal = '00970'"), out, "00970")
    sinks.write_certificates(rows, out, "full")
    found = sinks.certificates_of(spark, out, "code_postal", "00970")
    right = rows.filter("code_postal = '00970'").count()
    assert {(r.perimetre, r.lot): r["count"] for r in found.groupBy("perimetre", "lot").count().collect()} == {
        ("full", "pages"): right, ("00970", "pages"): right
    }
    assert sinks.certificates_of(spark, out, "code_postal", "99999").count() == 0


def test_certificates_without_any_code_are_written(spark, tmp_path):
    rows = certificates(spark).limit(10).withColumns({"code_postal": F.lit(None).cast("string"), "code_insee": F.lit(None).cast("string")})
    sinks.write_certificates(rows, str(tmp_path), "full")
    assert sources.read_table(spark, str(tmp_path)).count() == 10
    sinks.write_certificates(rows.limit(0), str(tmp_path), "full")
    assert sources.read_table(spark, str(tmp_path)).count() == 0


def test_a_commune_of_a_published_table_reads_one_row_group(spark, tmp_path, many_files):
    prices = spark.range(100_000).select(
        F.format_string("%05d", F.col("id") % 5000).alias("code_insee"), (F.col("id") % 20).cast("int").alias("annee"), F.col("id").alias("nb_ventes")
    )
    version = sinks.new_version(str(tmp_path))
    table = sinks.stage(prices, f"{version}/agg_commune_immo")
    sinks.publish(spark, version, {"none": prices.limit(0)})
    files = table.inputFiles()
    assert len(files) >= 45
    found = sinks.published_rows(spark, str(tmp_path), "agg_commune_immo", "00042")
    assert sorted(r.nb_ventes for r in found.collect()) == [42 + 5000 * i for i in range(20)]
    # Statistics alone would let nearly every file through: a commune lies within the range of each.
    within = sum(
        s.min <= "00042" <= s.max
        for f in files
        for s in [pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(0).column(0).statistics]
    )
    assert within > 5
    assert scanned(found)[0] <= 100_000 / 25


def test_offenders_are_counted_in_one_job(spark):
    prices = spark.range(1000).select(
        F.format_string("c%04d", 999 - F.col("id")).alias("code_insee"), F.lit(2024).alias("annee"),
        F.lit("Maison").alias("type_local"), (F.col("id") % 50).cast("int").alias("prix_m2_median"),
    )
    bad = quality.price_out_of_bounds(prices, (10, 40))
    tracker, group = spark.sparkContext.statusTracker(), "offenders"
    spark.sparkContext.setJobGroup(group, group)
    rows, examples = quality.offenders(bad, 3)
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows == bad.count() and examples == [tuple(r) for r in bad.orderBy(*bad.columns).limit(3).collect()]
    assert jobs == 1
    assert quality.offenders(bad.filter("annee = 1")) == (0, [])
    with pytest.raises(quality.QualityError) as raised:
        quality.require_no_violation({"a": bad.limit(0), "b": bad})
    assert (raised.value.check, raised.value.rows, len(raised.value.examples)) == ("b", rows, 10)


def test_standins_are_clustered_too(spark, tmp_path, many_files):
    rows = standins.certificates(spark, SMALL)
    sinks.write_certificates(rows, str(tmp_path), "full")
    code = rows.groupBy("code_postal").count().orderBy(F.col("count").desc()).first()["code_postal"]
    found = sinks.certificates_of(spark, str(tmp_path), "code_postal", code)
    assert found.count() == rows.filter(F.col("code_postal") == code).count()
    assert scanned(found)[1] <= 5
