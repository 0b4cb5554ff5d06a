"""Landing files, written tables, the stream and the whole jobs."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from habispark import plans, sinks, sources
from habispark.constants import CERTIFICATE_FIELDS, COG_COLUMNS, SALES_COLUMNS
from habispark.operators import certificates, restrict
from habispark.operators.quality import QualityError
from habispark.session import scratch_dir
from habispark.streaming import ingest_new_certificates
from tests.test_sales import BASE


def write_sales(folder, *overrides, columns=SALES_COLUMNS, name="part.csv.gz"):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join(columns)]
    for override in overrides:
        row = {**BASE, **override}
        lines.append(",".join(f'"{row[c]}"' if row.get(c) is not None else "" for c in columns))
    with gzip.open(folder / name, "wt", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")


def page(*rows, **more):
    return {"total": len(rows), "results": list(rows), **more}


def certificate(number, **fields):
    row = dict.fromkeys(CERTIFICATE_FIELDS, "x")
    own = {
        "numero_dpe": number, "code_postal": "69001", "code_insee": "69381", "classe_dpe": "D",
        "conso_energie": 120.5, "surface_habitable": 60, "annee_construction": 1975,
    }
    row.update({field: own[name] for field, name in CERTIFICATE_FIELDS.items() if name in own})
    row.update(fields)
    return {k: v for k, v in row.items() if v is not None}


def test_sales_keep_text_and_partition_columns(spark, tmp_path):
    write_sales(tmp_path / "annee_fichier=2023" / "departement=01", {"code_departement": "01", "adresse_numero": "NA"})
    write_sales(tmp_path / "annee_fichier=2024" / "departement=2A", {"code_departement": "2A"},
                {"code_departement": "2A", "type_local": ""})
    df = sources.read_sales(spark, str(tmp_path))
    types = dict(df.dtypes)
    assert {types[c] for c in SALES_COLUMNS} == {"string"}
    assert (types["annee_fichier"], types["departement"]) == ("int", "string")
    rows = df.orderBy("annee_fichier", "type_local").collect()
    assert [(r.annee_fichier, r.departement, r.code_departement) for r in rows] == [
        (2023, "01", "01"), (2024, "2A", "2A"), (2024, "2A", "2A"),
    ]
    assert rows[0].adresse_numero is None and rows[1].type_local is None


def test_only_the_folders_of_the_years_are_read(spark, tmp_path):
    for year in (2021, 2023):
        write_sales(tmp_path / f"annee_fichier={year}", {})
    df = restrict.sales_of_years(sources.read_sales(spark, str(tmp_path)), [2023])
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :]
    assert "annee_fichier" in filters[: filters.index("]")] and df.count() == 1


def test_landed_years_need_no_file_content(spark, tmp_path):
    for year in (2021, 2023):
        folder = tmp_path / f"annee_fichier={year}"
        folder.mkdir()
        (folder / "x.csv.gz").write_bytes(b"not a gzip file")
    assert sorted(r.annee_fichier for r in sources.landed_years(spark, str(tmp_path)).collect()) == [2021, 2023]


def test_sales_without_a_column_are_refused(spark, tmp_path):
    write_sales(tmp_path / "annee_fichier=2023", {}, columns=[c for c in SALES_COLUMNS if c != "id_parcelle"])
    with pytest.raises(sources.SchemaError, match="id_parcelle"):
        sources.read_sales(spark, str(tmp_path))


def test_files_with_another_header_are_refused(spark, tmp_path):
    folder = tmp_path / "annee_fichier=2023"
    write_sales(folder, {}, name="a.csv.gz")
    write_sales(folder, {}, columns=tuple(reversed(SALES_COLUMNS)), name="b.csv.gz")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_sales(spark, str(tmp_path)).collect()


def test_certificate_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps(page(certificate("a"), certificate("b", Etiquette_GES=None), next="x")))
    (tmp_path / "p2.json").write_text(json.dumps(page(certificate("c", **{"Conso_5_usages_é_finale": "?"}))))
    (tmp_path / "p3.json").write_text(json.dumps({"total": 0, "results": []}))
    df = certificates.clean_certificates(sources.read_certificates(spark, str(tmp_path)))
    assert df.columns == list(CERTIFICATE_FIELDS.values())
    assert (dict(df.dtypes)["conso_energie"], dict(df.dtypes)["annee_construction"]) == ("double", "bigint")
    rows = {r.numero_dpe: r for r in df.collect()}
    assert set(rows) == {"a", "b", "c"}
    assert (rows["a"].conso_energie, rows["c"].conso_energie, rows["b"].classe_ges) == (120.5, None, None)
    maps = sources.certificate_columns(sources.read_certificate_maps(spark, str(tmp_path)))
    assert sorted(certificates.clean_certificates(maps).collect()) == sorted(df.collect())


def test_indented_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps(page(certificate("a"), certificate("b")), indent=2))
    assert sources.read_certificates(spark, str(tmp_path), multiline=True).count() == 2


def test_certificate_field_that_no_row_has(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    rows = [certificate("a", Etiquette_GES=None), certificate("b", Etiquette_GES=None)]
    (landing / "p1.json").write_text(json.dumps(page(*rows)))
    with pytest.raises(sources.SchemaError, match=r"\['Etiquette_GES'\]"):
        plans.ingest_certificates(spark, str(landing), out, everything=True)
    # A null value counts as present.
    rows[1]["Etiquette_GES"] = None
    (landing / "p1.json").write_text(json.dumps(page(*rows)))
    plans.ingest_certificates(spark, str(landing), out, everything=True)
    assert sources.read_table(spark, out).count() == 2


def test_no_certificates(spark, tmp_path, caplog):
    (tmp_path / "p1.json").write_text(json.dumps({"total": 0, "results": []}))
    plans.ingest_certificates(spark, str(tmp_path), str(tmp_path / "out"), everything=True)
    assert "no certificates" in caplog.text and not (tmp_path / "out").exists()


def test_certificates_by_scope(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    other = certificate("b", **{"Code_postal_(BAN)": "01000"})
    (landing / "p1.json").write_text(json.dumps(page(certificate("a"), other)))
    with pytest.raises(ValueError, match="explicitly"):
        plans.ingest_certificates(spark, str(landing), out)
    plans.ingest_certificates(spark, str(landing), out, postcode="69001")
    plans.ingest_certificates(spark, str(landing), out, postcode="01000")
    plans.ingest_certificates(spark, str(landing), out, postcode="69001")
    rows = sources.read_table(spark, out, ["numero_dpe"]).select("numero_dpe", "perimetre").collect()
    assert sorted(r.numero_dpe for r in rows) == ["a", "b"]


def test_stream_reads_each_page_once(spark, tmp_path):
    landing, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    landing.mkdir()

    def run():
        ingest_new_certificates(spark, str(landing), target, state, everything=True)
        return sorted(r.numero_dpe for r in sources.read_table(spark, target).filter("perimetre = 'full'").collect())

    (landing / "p1.json").write_text(json.dumps(page(certificate("a"), certificate("b"))))
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    (landing / "p2.json").write_text(json.dumps(page(certificate("c"))))
    assert run() == ["a", "b", "c"]
    # A scope of its own has a checkpoint of its own.
    ingest_new_certificates(spark, str(landing), target, state, postcode="69001")
    assert sources.read_table(spark, target).filter("perimetre = '69001'").count() == 3
    with pytest.raises(ValueError, match="explicitly"):
        ingest_new_certificates(spark, str(landing), target, state)


def test_stream_goes_on_after_a_failure(spark, tmp_path):
    landing, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    landing.mkdir()

    def land(name, *rows, age):
        (landing / name).write_text(json.dumps(page(*rows)))
        os.utime(landing / name, (age, age))

    def run():
        ingest_new_certificates(spark, str(landing), target, state, everything=True, files_per_batch=1)

    land("p1.json", certificate("a"), age=1_700_000_000)
    land("p2.json", certificate("b", **{"Année_construction": 1975.5}), age=1_700_000_100)
    land("p3.json", certificate("c"), age=1_700_000_200)
    with pytest.raises(Exception, match="not a whole number"):
        run()
    assert [r.numero_dpe for r in sources.read_table(spark, target).filter("perimetre = 'full'").collect()] == ["a"]
    land("p2.json", certificate("b"), age=1_700_000_100)
    run()
    assert sorted(r.numero_dpe for r in sources.read_table(spark, target).filter("perimetre = 'full'").collect()) == ["a", "b", "c"]


def test_rewriting_one_department_keeps_the_others(spark, tmp_path):
    def frame(*rows):
        return spark.createDataFrame(rows, "id_mutation string, annee_fichier int, code_departement string")

    out = str(tmp_path)
    sinks.write_sales(frame(("1", 2023, "01"), ("2", 2023, "69")), out)
    sinks.write_sales(frame(("3", 2023, "69")), out)
    assert sorted(r.id_mutation for r in sources.read_table(spark, out).collect()) == ["1", "3"]


def test_partition_codes_keep_leading_zeros(spark, tmp_path):
    df = spark.createDataFrame([("1", 2023, "01"), ("2", 2023, None)], "id_mutation string, annee_fichier int, code_departement string")
    sinks.write_sales(df, str(tmp_path))
    table = sources.read_table(spark, str(tmp_path))
    assert dict(table.dtypes) == {"id_mutation": "string", "annee_fichier": "int", "code_departement": "string"}
    assert {r.code_departement for r in table.collect()} == {"01", None}


def test_parquet_files_may_have_more_columns(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/k=1")
    spark.range(3).withColumn("more", F.lit("m")).write.parquet(f"{tmp_path}/k=2")
    df = sources.read_table(spark, str(tmp_path), ["id"])
    assert df.count() == 5 and df.filter("more is null").count() == 2
    with pytest.raises(sources.SchemaError, match="absent"):
        sources.read_table(spark, str(tmp_path), ["absent"])


def test_a_file_without_a_required_column_is_refused(spark, tmp_path):
    """The merged schema has the column, so only the footers tell."""
    rows = spark.range(20).select("id", F.lit("69381").alias("code_insee"))
    rows.repartition(6).write.parquet(f"{tmp_path}/k=1")
    rows.withColumn("more", F.lit("m")).write.parquet(f"{tmp_path}/k=2")
    assert sources.read_table(spark, str(tmp_path), ["id", "code_insee", "k"]).count() == 40
    rows.select("id").repartition(3).write.parquet(f"{tmp_path}/k=3")
    with pytest.raises(sources.SchemaError, match=r"3 required columns .*code_insee in .*k=3/part-") as raised:
        sources.read_table(spark, str(tmp_path), ["id", "code_insee"])
    assert raised.value.missing == ("code_insee",)
    assert sources.read_table(spark, str(tmp_path), ["id"]).count() == 60
    lacking = {(r.path.rsplit("/", 2)[1], r.column) for r in sources.files_without(spark, str(tmp_path), ["more", "id"]).collect()}
    assert lacking == {("k=1", "more"), ("k=3", "more")}


def test_footers_in_a_store_that_only_spark_opens(spark, tmp_path, monkeypatch):
    spark.range(3).write.parquet(f"{tmp_path}/k=1")
    spark.range(3).withColumnRenamed("id", "other").write.parquet(f"{tmp_path}/k=2")
    expected = sorted(map(tuple, sources.files_without(spark, str(tmp_path), ["id", "k"]).collect()))
    monkeypatch.setattr(sources.files, "ARROW_STORES", ())
    assert sorted(map(tuple, sources.files_without(spark, str(tmp_path), ["id", "k"]).collect())) == expected
    assert len(expected) >= 1


def test_latest_snapshot(spark):
    rows = [
        ("Liste des communes au 01/01/2023", "https://x/2023.csv"),
        ("LISTE DES COMMUNES au 01/01/2024", "https://x/2024.zip"),
        ("Liste des communes au 01/01/2024", "https://x/2024.csv"),
        ("Liste des communes au 01/01/2025", "https://x/2025.xlsx"),
        ("Liste des communes outre-mer au 01/01/2025", "https://x/om.csv"),
        ("Liste des cantons au 01/01/2025", "https://x/cantons.csv"),
        (None, "https://x/none.csv"),
    ]
    df = spark.createDataFrame(rows, "title string, url string")
    assert [r.url for r in sources.latest_snapshot(df).collect()] == ["https://x/2024.zip"]
    assert sources.latest_snapshot_url(df) == "https://x/2024.zip"
    with pytest.raises(LookupError):
        sources.latest_snapshot_url(df.filter("title like '%cantons%'"))


@pytest.fixture
def landed(spark, tmp_path):
    """Three départements of sales, certificates, the commune list and geocoder answers."""
    for year in (2018, 2019, 2020, 2021, 2022, 2023):
        for code in ("01", "69"):
            write_sales(
                tmp_path / "sales" / f"annee_fichier={year}" / f"departement={code}",
                *[
                    {"id_mutation": f"{year}-{i}", "date_mutation": f"{year}-03-01", "code_departement": code,
                     "code_commune": f"{code}001", "valeur_fonciere": f"{100000 + i},5", "surface_reelle_bati": "50"}
                    for i in range(4)
                ],
                {"nature_mutation": "Échange"},
            )
    pages = tmp_path / "pages"
    pages.mkdir()
    rows = [certificate(f"n{i}", **{"Code_INSEE_(BAN)": "69001", "Etiquette_DPE": "AB"[i % 2]}) for i in range(12)]
    rows += [certificate(f"m{i}", **{"Code_INSEE_(BAN)": "01001"}) for i in range(3)]
    (pages / "p1.json").write_text(json.dumps(page(*rows[:8])))
    (pages / "p2.json").write_text(json.dumps(page(*rows[8:])))
    cog = tmp_path / "cog"
    cog.mkdir()
    lines = [",".join(COG_COLUMNS), "COM,01001,84,01,Abergement,x,", "COM,69001,84,69,L'Été,x,", "COMD,69002,84,69,Vieux,x,"]
    (cog / "communes.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    geocoded = tmp_path / "geocoded"
    geocoded.mkdir()
    (geocoded / "b1.csv").write_text("code_insee,commune,result_citycode,latitude,longitude\n69001,x,69001,45.5,4.8\n")
    return tmp_path


def test_whole_flow(spark, landed):
    at = lambda name: str(landed / name)
    funnel = {r.annee_fichier: r for r in plans.ingest_sales(spark, at("sales"), at("t_sales")).collect()}
    assert set(funnel) == {2019, 2020, 2021, 2022, 2023, None}
    assert funnel[2023].lignes_retenues == 8 and funnel[None].lignes_brutes == 50
    assert funnel[None].taux_retention_pct == 80.0 and funnel[None].statut == "warn"
    plans.ingest_certificates(spark, at("pages"), at("t_certificates"), everything=True)
    profile = plans.ingest_communes(spark, at("cog"), at("t_communes"), at("geocoded")).first()
    assert tuple(profile) == (2, 2, 1)

    report = plans.publish_results(spark, at("t_sales"), at("t_certificates"), at("t_communes"), at("out"))
    assert {r.mesure: r.lignes for r in report.collect()} == {
        "lignes_dvf": 40, "lignes_dvf_retenues": 40, "lignes_dpe": 15, "lignes_dpe_retenues": 15,
        "communes_total": 2, "communes_eligibles": 1,
    }
    assert [r.code_insee for r in sinks.read_published(spark, at("out"), "communes_eligible").collect()] == ["69001"]
    prices = sinks.read_published(spark, at("out"), "agg_commune_immo").filter("code_insee = '69001' and annee = 2023").first()
    assert (prices.nb_ventes, prices.prix_median, prices.prix_m2_median) == (4, 100002, 2000)
    assert sinks.read_published(spark, at("out"), "communes").filter("slug = 'l-ete' and latitude = 45.5").count() == 1

    report = plans.publish_results(spark, at("t_sales"), at("t_certificates"), at("t_communes"), at("out01"), "01")
    counts = {r.mesure: r.lignes for r in report.collect()}
    assert (counts["lignes_dvf_retenues"], counts["lignes_dpe_retenues"]) == (20, 3)
    report = plans.publish_results(spark, at("t_sales"), at("t_certificates"), at("t_communes"), at("out69"), "69")
    counts = {r.mesure: r.lignes for r in report.collect()}
    assert (counts["lignes_dvf"], counts["lignes_dvf_retenues"]) == (40, 20)
    assert (counts["lignes_dpe"], counts["lignes_dpe_retenues"]) == (15, 12)


def test_requested_years_and_department(spark, landed, caplog):
    report = plans.ingest_sales(spark, str(landed / "sales"), str(landed / "out"), [2018, 2030], "69")
    assert {r.annee_fichier for r in report.collect()} == {2018, None}
    assert "2030" in caplog.text
    assert sources.read_table(spark, str(landed / "out")).count() == 4


def test_failed_check_leaves_the_published_tables(spark, landed):
    at = lambda name: str(landed / name)
    plans.ingest_sales(spark, at("sales"), at("t_sales"))
    plans.ingest_certificates(spark, at("pages"), at("t_certificates"), everything=True)
    plans.ingest_communes(spark, at("cog"), at("t_communes"))
    inputs = [sources.read_table(spark, at(t)) for t in ("t_sales", "t_certificates", "t_communes")]
    plans.build_and_publish(*inputs, at("out"))
    inputs[0] = inputs[0].withColumn("valeur_fonciere", F.lit(1.0))
    with pytest.raises(QualityError, match="prix_m2_bornes"):
        plans.build_and_publish(*inputs, at("out"))
    assert sinks.read_published(spark, at("out"), "agg_commune_immo").filter("prix_m2_median < 100").count() == 0


def test_duplicate_slugs_stop_the_commune_job(spark, tmp_path):
    lines = [",".join(COG_COLUMNS), "COM,1,84,01,a,x,", "COM,2,84,01,a,x,", "COM,3,84,01,a 1,x,"]
    (tmp_path / "cog.csv").write_text("\n".join(lines) + "\n")
    with pytest.raises(QualityError, match="a-1"):
        plans.ingest_communes(spark, str(tmp_path / "cog.csv"), str(tmp_path / "out"), department="69")
    assert not (tmp_path / "out").exists()


def test_communes_of_one_department_keep_their_numbers(spark, tmp_path):
    lines = [",".join(COG_COLUMNS), "COM,1,84,01,a,x,", "COM,2,84,69,a,x,", "COM,3,84,69,b,x,"]
    (tmp_path / "cog.csv").write_text("\n".join(lines) + "\n")
    profile = plans.ingest_communes(spark, str(tmp_path / "cog.csv"), str(tmp_path / "out"), department="69")
    assert tuple(profile.first()) == (2, 2, 0)
    assert sorted(r.slug for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a-1", "b"]


def test_communes_without_geocoder_answers(spark, landed, caplog):
    (landed / "none").mkdir()
    for folder in ("none", "absent"):
        profile = plans.ingest_communes(spark, str(landed / "cog"), str(landed / "out"), str(landed / folder))
        assert tuple(profile.first()) == (2, 2, 0)
        assert folder in caplog.text


def test_department_of_a_country_file(spark, tmp_path):
    write_sales(tmp_path / "in" / "annee_fichier=2023", {}, {"id_mutation": "2", "code_departement": "01"})
    report = plans.ingest_sales(spark, str(tmp_path / "in"), str(tmp_path / "out"), department="01").collect()
    assert {r.annee_fichier: r.lignes_brutes for r in report} == {2023: 1, None: 1}


def test_scratch_folder_is_the_shared_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(root) and first != second


def test_a_rerun_replaces_what_its_files_gave(spark, tmp_path):
    columns = "id_mutation string, annee_fichier int, departement string, code_departement string"
    frame = lambda *rows: spark.createDataFrame(list(rows), columns)
    out = str(tmp_path / "sales")
    sinks.write_sales(frame(*[(str(i), 2023, "01", "01") for i in range(5)], ("null", 2023, "01", None)), out)
    # A stray row of 01 and one without a département come with the file of 69.
    second = frame(("a", 2023, "69", "69"), ("b", 2023, "69", "01"), ("c", 2023, "69", None))
    sinks.write_sales(second, out, second)
    assert sources.read_table(spark, out).count() == 9
    sinks.write_sales(frame(("a", 2023, "69", "69")).limit(0), out, second)
    assert sources.read_table(spark, out).count() == 6
    with pytest.raises(ValueError):
        sinks.write_sales(second.drop("departement"), out)


def test_a_replacement_that_stops_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    columns = "id_mutation string, annee_fichier int, departement string"
    frame = lambda *rows: spark.createDataFrame(list(rows), columns)
    out = str(tmp_path / "sales")
    read = lambda: sorted(((r.annee_fichier, r.departement, r.id_mutation) for r in sources.read_table(spark, out).collect()), key=str)
    sinks.write_sales(frame(("1", 2022, "01"), ("2", 2023, "01"), ("3", 2023, "69"), ("4", 2023, None)), out)
    before, running = read(), sources.read_table(spark, out)
    landed = frame(("5", 2023, "01"), ("x", 2023, "69"), ("y", 2023, None), ("z", 2024, "01"))

    def stops(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        # Everything is written and only the record is missing.
        patch.setattr(sinks.tables.commits, "commit", stops)
        with pytest.raises(OSError, match="lost"):
            sinks.write_sales(frame(("5", 2023, "01")), out, landed)
    assert read() == before
    sinks.write_sales(frame(("5", 2023, "01")), out, landed)
    assert read() == [(2022, "01", "1"), (2023, "01", "5")]
    # A read that began earlier still finds its files; they go with the record after the next one.
    assert running.count() == 4
    for i in range(3):
        sinks.write_sales(frame((f"n{i}", 2023, "01")), out)
    assert read() == [(2022, "01", "1"), (2023, "01", "n2")]
    assert len(list((tmp_path / "sales" / "_commits").glob("[0-9]*"))) == 2
    assert sorted(str(p.relative_to(tmp_path / "sales")) for p in (tmp_path / "sales").glob("*/annee_fichier=*/departement=*")) == [
        "generation=0/annee_fichier=2022/departement=01", "generation=3/annee_fichier=2023/departement=01",
        "generation=4/annee_fichier=2023/departement=01",
    ]


def test_a_second_writer_of_the_same_record_is_refused(spark, tmp_path):
    from habispark import commits

    commits.commit(spark, str(tmp_path), 0, ["a"])
    with pytest.raises(RuntimeError, match="another run"):
        commits.commit(spark, str(tmp_path), 0, ["b"])
    assert commits.live_folders(spark, str(tmp_path)) == ["a"]
    assert commits.live_folders(spark, str(tmp_path / "none")) is None


def test_communes_are_replaced_at_once(spark, tmp_path, monkeypatch):
    frame = lambda *codes: spark.createDataFrame([(c, c) for c in codes], "code_insee string, slug string")
    out = str(tmp_path / "communes")
    sinks.write_communes(frame("01", "02"), out)
    with monkeypatch.context() as patch:
        patch.setattr(sinks.tables.commits, "commit", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sinks.write_communes(frame("03"), out)
    table = sources.read_table(spark, out)
    assert sorted(r.code_insee for r in table.collect()) == ["01", "02"] and table.columns == ["code_insee", "slug"]
    sinks.write_communes(frame("03"), out)
    assert [r.code_insee for r in sources.read_table(spark, out).collect()] == ["03"]


def test_latest_years_of_a_stored_table_come_from_its_folders(spark, tmp_path):
    rows = [(str(y), y, "01") for y in range(2010, 2024)]
    sinks.write_sales(spark.createDataFrame(rows, "id_mutation string, annee_fichier int, departement string"), str(tmp_path))
    found = restrict.latest_stored_years(spark, str(tmp_path), 3)
    assert sorted(r.annee_fichier for r in found.collect()) == [2021, 2022, 2023]
    assert len(found.inputFiles()) >= 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "annee_fichier" in plan[plan.index("PartitionFilters: [") :].split("]")[0]


def test_geocoder_answers_keep_their_order(spark, tmp_path):
    from habispark.sources import read_geocoded

    (tmp_path / "batch.csv").write_text("code,latitude\n" + "".join(f"x,{v}\n" for v in ("45.9", "5.1", "45.1")))
    found = read_geocoded(spark, str(tmp_path)).orderBy("fichier", "position").collect()
    assert [str(r.latitude) for r in found] == ["45.9", "5.1", "45.1"]


def test_quoted_line_breaks_stay_in_their_cell(spark, tmp_path):
    folder = tmp_path / "annee_fichier=2023"
    write_sales(folder, {"adresse_nom_voie": "RUE\nHAUTE"}, {"adresse_nom_voie": "PLACE"})
    from habispark.sources import read_sales

    assert sorted(r.adresse_nom_voie for r in read_sales(spark, str(tmp_path)).collect()) == ["PLACE", "RUE\nHAUTE"]


def test_years_may_differ_in_extra_columns(spark, tmp_path):
    write_sales(tmp_path / "annee_fichier=2022", {})
    write_sales(tmp_path / "annee_fichier=2023", {"extra": "e"}, columns=[*SALES_COLUMNS, "extra"])
    rows = sources.read_sales(spark, str(tmp_path)).orderBy("annee_fichier").collect()
    assert [r.extra for r in rows] == [None, "e"]
    write_sales(tmp_path / "annee_fichier=2024" / "departement=01", {})
    with pytest.raises(Exception, match="CONFLICTING_PARTITION_COLUMN_NAMES"):
        sources.read_sales(spark, str(tmp_path))


def test_stream_refuses_pages_without_a_field_and_feeds_the_batch_table(spark, tmp_path):
    landing, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    landing.mkdir()
    (landing / "p1.json").write_text(json.dumps(page(certificate("a", Etiquette_GES=None))))
    with pytest.raises(Exception, match="Etiquette_GES"):
        ingest_new_certificates(spark, str(landing), target, state, everything=True)
    (landing / "p1.json").write_text(json.dumps(page(certificate("a"), certificate("b"))))
    ingest_new_certificates(spark, str(landing), target, state, everything=True)
    plans.ingest_certificates(spark, str(landing), target, postcode="69001")
    table = sources.read_table(spark, target)
    assert table.count() == 4
    assert sorted(r.numero_dpe for r in certificates.unique_certificates(table).collect()) == ["a", "b"]
    # All pages of a scope at once replace its lots.
    plans.ingest_certificates(spark, str(landing), target, everything=True)
    assert sources.read_table(spark, target).filter("perimetre = 'full'").count() == 2


def test_unique_certificates_keep_the_latest_and_rows_without_a_number(spark):
    rows = [("a", "2020-01-01", 1), ("a", "2021-01-01", 2), (None, None, 3), (None, None, 3)]
    df = spark.createDataFrame(rows, "numero_dpe string, date_etablissement string, v int")
    assert sorted(r.v for r in certificates.unique_certificates(df).collect()) == [2, 3, 3]


def test_a_publication_that_stops_half_way_leaves_the_one_before(spark, landed, monkeypatch):
    at = lambda name: str(landed / name)
    plans.ingest_sales(spark, at("sales"), at("t_sales"))
    plans.ingest_certificates(spark, at("pages"), at("t_certificates"), everything=True)
    plans.ingest_communes(spark, at("cog"), at("t_communes"))
    inputs = [sources.read_table(spark, at(t)) for t in ("t_sales", "t_certificates", "t_communes")]
    plans.build_and_publish(*inputs, at("out"))
    before = sinks.read_published(spark, at("out"), "agg_commune_dpe").collect()
    written = []

    def stops(df, path):
        if len(written) == 2:
            raise OSError("disk full")
        written.append(path)
        return sinks.stage(df, path)

    with monkeypatch.context() as patch:
        patch.setattr(plans.jobs, "stage", stops)
        with pytest.raises(OSError, match="disk full"):
            plans.build_and_publish(*inputs, at("out"))
    assert sinks.read_published(spark, at("out"), "agg_commune_dpe").collect() == before
    assert len(list((landed / "out").glob("version-*"))) == 1
    for _ in range(2):
        plans.build_and_publish(*inputs, at("out"))
    assert len(list((landed / "out").glob("version-*"))) == 2
