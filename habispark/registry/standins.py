"""The given tables seen as sales, certificates and communes.

Commune codes are the digits of a key, reversed, so that their first two characters (the
département) vary; codes that start with 97 have a three-character département.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from habispark.constants import CERTIFICATE_FIELDS

# Columns of the given tables that are used here; a stated schema saves a job per read.
SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
    "part": "p_partkey long, p_name string, p_size int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    "documents": "doc_id long, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _code(key: str) -> str:
    return f"reverse(lpad(cast({key} as string), 9, '0'))"


def _department(code: str) -> str:
    return f"case when left({code}, 2) = '97' then left({code}, 3) else left({code}, 2) end"


def commune_code(key: str) -> Column:
    return F.expr(_code(key))


def department_of(key: str) -> Column:
    return F.expr(_department(_code(key)))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as sale rows: the order is the deed, the supplier the commune.

    The first lines of an order share the customer's parcel, later ones have a parcel of their own.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    code, number = _code("l_suppkey"), "cast(l_linenumber as string)"
    return lines.join(orders, F.expr("l_orderkey = o_orderkey")).selectExpr(
        "l_orderkey as id_mutation",
        "date_format(o_orderdate, 'yyyy-MM-dd') as date_mutation",
        "case o_orderstatus when 'O' then 'Vente' when 'F' then 'Echange' end as nature_mutation",
        "case when l_linenumber <> 7 then l_extendedprice end as valeur_fonciere",
        f"{number} as adresse_numero",
        f"'RUE ' || {number} as adresse_nom_voie",
        f"{number} as adresse_code_voie",
        f"left({code}, 5) as code_postal",
        f"{code} as code_commune",
        "'Commune ' || cast(l_suppkey as string) as nom_commune",
        f"case when l_discount < 0.1D then {_department(code)} end as code_departement",
        "case when l_linenumber < 6 then o_custkey else l_partkey end as id_parcelle",
        "case l_returnflag when 'A' then 'Appartement' when 'R' then 'Maison' else 'Dependance' end as type_local",
        "l_quantity as surface_reelle_bati",
        f"{number} as nombre_pieces_principales",
        "l_tax as surface_terrain",
        "l_discount as longitude",
        "l_tax as latitude",
        "year(o_orderdate) as annee_fichier",
        f"case when l_linenumber > 1 then {code} || '-' || {number} end as id_voie",
        "l_orderkey as dpe_numero",
    )


_ENERGY = """case event_type when 'view' then 'A' when 'click' then 'C' when 'signup' then 'E'
when 'error' then 'G' else 'N' end"""


def certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as certificates: the user is the commune, the event type the energy class."""
    code = _code("user_id")
    return table(spark, sf_dir, "events").selectExpr(
        "event_id as numero_dpe",
        f"left({code}, 5) as code_postal",
        f"case when value < 1 then null when value > 100 then '' else {code} end as code_insee",
        "'RUE ' || cast(user_id as string) as adresse",
        f"{_ENERGY} as classe_dpe",
        f"{_ENERGY} as classe_ges",
        "case when value >= 5 then value end as conso_energie",
        "value as surface_habitable",
        "year(ts) as annee_construction",
        "date_format(ts, 'yyyy-MM-dd') as date_etablissement",
        "cast(user_id as double) as longitude",
        "value as latitude",
    )


def certificate_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same under the service's field names, with consumption as text that may be no number."""
    rows = certificates(spark, sf_dir).withColumn(
        "conso_energie", F.coalesce(F.col("conso_energie").cast("string"), F.lit("inconnue"))
    )
    return rows.withColumnsRenamed({new: field for field, new in CERTIFICATE_FIELDS.items()})


def communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as communes; some have no département."""
    code = _code("s_suppkey")
    return table(spark, sf_dir, "supplier").selectExpr(
        f"{code} as code_insee",
        "s_name as nom",
        f"case when s_nationkey <> 7 then {_department(code)} end as code_departement",
        "cast(null as double) as latitude",
        "cast(null as double) as longitude",
    )


def cog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The official list: parts as communes, suppliers as districts, customers as former communes."""

    def entities(name: str, kind: str, code: str, region: str, label: str) -> DataFrame:
        two = f"lpad(cast({region} as string), 2, '0')"
        return table(spark, sf_dir, name).selectExpr(
            f"'{kind}' as TYPECOM", f"{code} as COM", f"{two} as REG", f"{two} as DEP", f"{label} as LIBELLE",
            f"{label} as NCCENR", "cast(null as string) as COMPARENT",
        )

    communes_ = entities("part", "COM", _code("p_partkey"), "p_size", "\"L'Évêché \" || p_name")
    districts = entities("supplier", "ARM", "'M' || cast(s_suppkey as string)", "s_nationkey", "s_name")
    former = entities("customer", "COMD", "'D' || cast(c_custkey as string)", "c_nationkey", "c_name")
    return communes_.unionByName(districts).unionByName(former)


def geocoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as geocoder answers, several per commune, some without one of the coordinates."""
    code = _code("user_id")
    return table(spark, sf_dir, "events").selectExpr(
        f"{code} as code_insee",
        f"{code} as result_citycode",
        "case when event_type <> 'error' then cast(value as string) end as latitude",
        "case when event_type <> 'click' then cast(value as string) end as longitude",
        "event_id as ordre",
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as published resources: titles by year, urgent ones for overseas, low ones not as files."""
    return table(spark, sf_dir, "orders").selectExpr(
        """concat('Liste des communes ', case o_orderpriority when '1-URGENT' then 'outre-mer ' else '' end,
        'au 01/01/', cast(year(o_orderdate) as string)) as title""",
        """concat('https://example.org/', cast(o_orderkey as string), case o_orderpriority
        when '5-LOW' then '.html' when '2-HIGH' then '.zip' else '.csv' end) as url""",
    )
