"""The same results in SQL, written against the given tables; used only for comparison."""

from __future__ import annotations

from habispark.constants import CERTIFICATE_FIELDS, DEPARTMENT_NAMES, REGION_NAMES, SAMPLE_ROWS
from habispark.registry.queries import (
    COMMUNE_DEPARTMENT,
    DEPARTMENT,
    LATEST,
    MIN_CERTIFICATES,
    MIN_SALES,
    POSTCODE,
    PRICE_BOUNDS,
    REQUESTED_YEARS,
    REWRITTEN_YEAR,
    SHARE_BOUNDS,
    SHARE_SLACK,
)


def _code(key: str) -> str:
    return f"reverse(lpad(cast({key} as varchar), 9, '0'))"


def _department(code: str) -> str:
    return f"case when left({code}, 2) = '97' then left({code}, 3) else left({code}, 2) end"


def _slug(text: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents({text})), '[^a-z0-9]+', '-', 'g'), '-')"


def _values(names: dict[str, str]) -> str:
    quoted = [[x.replace("'", "''") for x in pair] for pair in names.items()]
    return "values " + ", ".join(f"('{code}', '{name}')" for code, name in quoted)


_CTES = {
    "sales": f"""
select l_orderkey id_mutation, strftime(o_orderdate, '%Y-%m-%d') date_mutation,
  case o_orderstatus when 'O' then 'Vente' when 'F' then 'Echange' end nature_mutation,
  case when l_linenumber <> 7 then l_extendedprice end valeur_fonciere,
  cast(l_linenumber as varchar) adresse_numero, 'RUE ' || l_linenumber adresse_nom_voie,
  cast(l_linenumber as varchar) adresse_code_voie, left({_code('l_suppkey')}, 5) code_postal,
  {_code('l_suppkey')} code_commune, 'Commune ' || l_suppkey nom_commune,
  case when l_discount < 0.1 then {_department(_code('l_suppkey'))} end code_departement,
  case when l_linenumber < 6 then o_custkey else l_partkey end id_parcelle,
  case l_returnflag when 'A' then 'Appartement' when 'R' then 'Maison' else 'Dependance' end type_local,
  l_quantity surface_reelle_bati, cast(l_linenumber as varchar) nombre_pieces_principales,
  l_tax surface_terrain, l_discount longitude, l_tax latitude,
  cast(year(o_orderdate) as integer) annee_fichier,
  case when l_linenumber > 1 then {_code('l_suppkey')} || '-' || l_linenumber end id_voie
from lineitem join orders on l_orderkey = o_orderkey""",
    "usable": """
select * from sales where nature_mutation = 'Vente' and type_local in ('Maison', 'Appartement')
  and valeur_fonciere > 0 and surface_reelle_bati > 9""",
    "multi": "select id_mutation from usable group by id_mutation having count(distinct id_parcelle) > 1",
    "clean": """
select u.* from usable u where not exists (select 1 from multi m where m.id_mutation = u.id_mutation)""",
    "certificates": f"""
select event_id numero_dpe, left({_code('user_id')}, 5) code_postal,
  case when value < 1 then null when value > 100 then '' else {_code('user_id')} end code_insee,
  'RUE ' || user_id adresse, c classe_dpe, c classe_ges,
  case when value >= 5 then value end conso_energie, value surface_habitable,
  cast(year(ts) as bigint) annee_construction, strftime(ts, '%Y-%m-%d') date_etablissement,
  cast(user_id as double) longitude, value latitude
from (select *, case event_type when 'view' then 'A' when 'click' then 'C' when 'signup' then 'E'
  when 'error' then 'G' else 'N' end c from events) e""",
    "communes": f"""
select {_code('s_suppkey')} code_insee, s_name nom,
  case when s_nationkey <> 7 then {_department(_code('s_suppkey'))} end code_departement from supplier""",
    "cog": f"""
select 'COM' typecom, {_code('p_partkey')} com, lpad(cast(p_size as varchar), 2, '0') reg,
  lpad(cast(p_size as varchar), 2, '0') dep, 'L''Évêché ' || p_name libelle from part
union all select 'ARM', 'M' || s_suppkey, lpad(cast(s_nationkey as varchar), 2, '0'),
  lpad(cast(s_nationkey as varchar), 2, '0'), s_name from supplier
union all select 'COMD', 'D' || c_custkey, lpad(cast(c_nationkey as varchar), 2, '0'),
  lpad(cast(c_nationkey as varchar), 2, '0'), c_name from customer""",
    "departments(code, name)": _values(DEPARTMENT_NAMES),
    "regions(code, name)": _values(REGION_NAMES),
    "built": f"""
select com code_insee, libelle nom, case when n = 0 then s else s || '-' || n end slug, '' codes_postaux,
  dep code_departement, coalesce(d.name, '') nom_departement, reg code_region,
  coalesce(r.name, '') nom_region, cast(null as bigint) population, cast(null as double) latitude,
  cast(null as double) longitude
from (select *, row_number() over (partition by s order by typecom = 'ARM', com) - 1 n
      from (select *, {_slug('libelle')} s from cog where typecom in ('COM', 'ARM')) a) b
left join departments d on d.code = dep left join regions r on r.code = reg""",
    "geocoded": f"""
select {_code('user_id')} code_insee, case when event_type <> 'error' then value end latitude,
  case when event_type <> 'click' then value end longitude, event_id ordre from events""",
    "found": """
select code_insee, arg_min(latitude, ordre) filter (where latitude is not null) latitude,
  arg_min(longitude, ordre) filter (where longitude is not null) longitude from geocoded group by code_insee""",
    "immo": """
select code_insee, annee, type_local, cast(p as integer) prix_median, cast(m as integer) prix_m2_median,
  cast(q1 as integer) prix_m2_p25, cast(q3 as integer) prix_m2_p75, cast(s as integer) surface_mediane, nb_ventes
from (select code_commune code_insee, cast(year(cast(date_mutation as date)) as integer) annee, type_local,
    count(*) nb_ventes, median(valeur_fonciere) p, median(valeur_fonciere / surface_reelle_bati) m,
    quantile_cont(valeur_fonciere / surface_reelle_bati, 0.25) q1,
    quantile_cont(valeur_fonciere / surface_reelle_bati, 0.75) q3, median(surface_reelle_bati) s
  from clean where surface_reelle_bati > 0 group by 1, 2, 3) g""",
    "energy": """
select code_insee, classe_dpe, count(*) nb_logements,
  round(100.0 * count(*) / sum(count(*)) over (partition by code_insee), 1) part_pct,
  cast((2 * 10 * sum(n) + 1000000000 * count(n)) // nullif(2 * 1000000000 * count(n), 0) as double) / 10 conso_moyenne
from (select *, cast(cast(cast(conso_energie as varchar) as decimal(28, 9)) * 1000000000 as hugeint) n from certificates) c
where classe_dpe in ('A', 'B', 'C', 'D', 'E', 'F', 'G')
  and code_insee is not null and code_insee <> '' group by code_insee, classe_dpe""",
    "eligible": f"""
select c.code_insee, c.nom from communes c
where exists (select 1 from immo i where i.code_insee = c.code_insee
    group by i.code_insee having sum(nb_ventes) >= {MIN_SALES})
  and exists (select 1 from energy e where e.code_insee = c.code_insee
    group by e.code_insee having sum(nb_logements) >= {MIN_CERTIFICATES})""",
    "funnel": """
select annee_fichier, count(*) lignes_brutes,
  count(*) filter (where coalesce(nature_mutation, '') <> 'Vente') exclues_non_vente,
  count(*) filter (where nature_mutation = 'Vente'
    and type_local not in ('Maison', 'Appartement')) exclues_type_local,
  count(*) filter (where nature_mutation = 'Vente' and type_local in ('Maison', 'Appartement')
    and coalesce(valeur_fonciere, 0) <= 0) exclues_prix_manquant,
  count(*) filter (where nature_mutation = 'Vente' and type_local in ('Maison', 'Appartement')
    and valeur_fonciere > 0 and surface_reelle_bati <= 9) exclues_surface_faible
from sales group by rollup (annee_fichier)""",
    "removed": """
select annee_fichier, count(distinct id_mutation) exclues_multi_lots, count(*) lignes_multi_lots
from usable where id_mutation in (select id_mutation from multi) group by rollup (annee_fichier)""",
    "retained": "select annee_fichier, count(*) lignes_retenues from clean group by rollup (annee_fichier)",
    "funnel_all": """
select f.*, coalesce(m.exclues_multi_lots, 0) exclues_multi_lots, coalesce(m.lignes_multi_lots, 0) lignes_multi_lots,
  coalesce(r.lignes_retenues, 0) lignes_retenues,
  round(100.0 * coalesce(r.lignes_retenues, 0) / f.lignes_brutes, 1) taux_retention_pct
from funnel f left join removed m on f.annee_fichier is not distinct from m.annee_fichier
  left join retained r on f.annee_fichier is not distinct from r.annee_fichier""",
}
# Which of the above each one reads.
_NEEDS = {
    "usable": ["sales"], "multi": ["usable"], "clean": ["multi"], "built": ["cog", "departments(code, name)",
    "regions(code, name)"], "found": ["geocoded"], "immo": ["clean"], "energy": ["certificates"],
    "eligible": ["communes", "immo", "energy"], "funnel": ["sales"], "removed": ["multi"],
    "retained": ["clean"], "funnel_all": ["funnel", "removed", "retained"],
}


def _with(select: str, *names: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    ctes = ", ".join(
        f"{n.replace('(', ' (', 1)} as ({_CTES[n].strip()})" for n in ordered
    )
    return f"with {ctes} {select.strip()}"


_CERTIFICATE_COLUMNS = """numero_dpe, code_postal, code_insee, adresse, classe_dpe, classe_ges, conso_energie,
  surface_habitable, annee_construction, date_etablissement, longitude, latitude"""


def oracles() -> dict[str, str]:
    in_department = f"""code_insee is null or left(code_insee, 2) = '{DEPARTMENT}'
  or left(code_insee, 3) = '{DEPARTMENT}'"""
    greenhouse = next(field for field, name in CERTIFICATE_FIELDS.items() if name == "classe_ges")
    years = " union all ".join(f"select {y} y" for y in REQUESTED_YEARS)
    return {
        "src_sales_csv": _with("""
select cast(id_mutation as varchar) id_mutation, date_mutation, nature_mutation, type_local, valeur_fonciere,
  surface_reelle_bati, code_commune, code_departement, cast(id_parcelle as varchar) id_parcelle, annee_fichier,
  '0' || left(code_commune, 1) departement from sales""", "sales"),
        "src_sales_country_csv": _with(f"""
select cast(id_mutation as varchar) id_mutation, valeur_fonciere, code_commune, annee_fichier,
  case when annee_fichier = {REWRITTEN_YEAR} then 'a, "b"' || chr(10) || 'c' end remarque from sales""", "sales"),
        "src_geocoded_csv": _with("""
select code_insee, cast(latitude as varchar) latitude, cast(longitude as varchar) longitude from found""",
            "found"),
        "write_sales_twice": _with(f"""
select id_mutation, id_parcelle, type_local, code_departement, annee_fichier from clean
where annee_fichier <> {REWRITTEN_YEAR} or type_local = 'Maison'""", "clean"),
        "write_certificates_scopes": _with("""
select numero_dpe, code_postal, code_insee, classe_dpe, conso_energie from certificates""", "certificates"),
        "write_communes_table": _with("select code_insee, nom, code_departement from communes", "communes"),
        "src_communes_csv": _with("""
select typecom "TYPECOM", com "COM", reg "REG", dep "DEP", libelle "LIBELLE", cast(null as varchar) "COMPARENT"
from cog""", "cog"),
        "src_certificates_json": _with("""
select cast(numero_dpe as varchar) numero_dpe, code_postal, code_insee, classe_dpe,
  cast(annee_construction as varchar) annee_construction, date_etablissement from certificates""",
            "certificates"),
        "src_parquet_glob": _with("""
select numero_dpe, code_insee, classe_dpe, conso_energie, case when classe_dpe = 'N' then 'sans classe' end remarque
from certificates""", "certificates"),
        "latest_snapshot": """
select title, url from (
  select lower('Liste des communes ' || case o_orderpriority when '1-URGENT' then 'outre-mer ' else '' end
      || 'au 01/01/' || year(o_orderdate)) title,
    'https://example.org/' || o_orderkey || case o_orderpriority when '5-LOW' then '.html'
      when '2-HIGH' then '.zip' else '.csv' end url
  from orders) m
where title not like '%outre-mer%' and (url like '%.csv' or url like '%.zip') order by title desc, url desc limit 1""",
        "normalize_null_tokens": """
select c_custkey, case when c_mktsegment in ('HOUSEHOLD', 'MACHINERY', 'BUILDING') then null
  when c_mktsegment = 'FURNITURE' then ' NA ' else c_mktsegment end segment from customer""",
        "publish_tables": _with("""
select 'communes' nom_table, code_insee, nom, coalesce(code_departement, 'inconnu') code_departement from communes
union all by name select 'agg_commune_immo' nom_table, * from immo
union all by name select 'agg_commune_dpe' nom_table, * from energy
union all by name select 'communes_eligible' nom_table, code_insee from eligible""", "eligible"),
        "publish_refused": _with(f"""
select 'prix_m2_bornes' controle, count(*) lignes from immo
where prix_m2_median < {PRICE_BOUNDS[0]} or prix_m2_median > {PRICE_BOUNDS[1]} having count(*) > 0
union all select 'communes_departement', count(*) from immo i left join communes c on i.code_insee = c.code_insee
where c.code_departement is null having count(*) > 0
union all select 'publie', count(*) from immo""", "immo", "communes"),
        "published_lookup": _with("""
select * from immo where code_insee = (
  select code_insee from immo group by 1 order by count(*) desc, code_insee limit 1)""", "immo"),
        "src_parquet_refused": """
select distinct '1' partie, 'code_insee' colonne from events where event_type not in ('view', 'click', 'signup', 'error')""",
        "refused_inputs": f"""
select 'ventes' entree, 'id_parcelle' colonne from lineitem union select 'communes', 'REG' from part
union select 'certificats', '{greenhouse}' from events""",
        "check_samples": _with(f"""
select * from (
  select 'prix_m2_bornes' controle, count(*) over () lignes,
    cast(row_number() over (order by code_insee nulls first, annee, type_local, prix_m2_median) as integer) rang,
    concat_ws('|', code_insee, annee, type_local, prix_m2_median) exemple
  from immo where prix_m2_median < {PRICE_BOUNDS[0]} or prix_m2_median > {PRICE_BOUNDS[1]}
  union all select 'communes_departement', count(*) over (),
    cast(row_number() over (order by i.code_insee nulls first) as integer), i.code_insee
  from immo i left join communes c on i.code_insee = c.code_insee where c.code_departement is null) s
where rang <= {SAMPLE_ROWS}""", "immo", "communes"),
        "certificates_stream": _with("""
select cast(numero_dpe as varchar) numero_dpe, code_postal, code_insee, adresse, classe_dpe, classe_ges,
  conso_energie, surface_habitable, annee_construction, date_etablissement,
  longitude || '' longitude, cast(latitude as varchar) latitude from certificates""", "certificates"),
        "coverage_report": _with(f"""
select 'lignes_dvf' mesure, count(*) lignes from clean
union all select 'lignes_dvf_retenues', count(*) from clean
  where code_departement = '{DEPARTMENT}' or code_departement is null
union all select 'lignes_dpe', count(*) from certificates
union all select 'lignes_dpe_retenues', count(*) from certificates where {in_department}
union all select 'communes_total', count(*) from communes
union all select 'communes_eligibles', count(*) from eligible""", "eligible"),
        "certificates_rename": _with("""
select numero_dpe, code_postal, code_insee, adresse, classe_dpe, classe_ges,
  coalesce(cast(conso_energie as varchar), 'inconnue') conso_energie, surface_habitable,
  cast(annee_construction as integer) annee_construction, date_etablissement, longitude, latitude
from certificates""", "certificates"),
        "clean_certificates": _with(f"select {_CERTIFICATE_COLUMNS} from certificates", "certificates"),
        "parse_decimal_comma": "select l_orderkey, l_linenumber, l_extendedprice prix from lineitem",
        "lenient_numeric": """
select event_id, case when event_type in ('view', 'signup') then value end v from events""",
        "lenient_integer": """
select o_orderkey, case when o_orderstatus <> 'P' then cast(year(o_orderdate) as bigint) end annee from orders""",
        "price_per_m2": _with("""
select id_mutation, id_parcelle, valeur_fonciere / surface_reelle_bati prix_m2 from clean
where surface_reelle_bati > 0""", "clean"),
        "sale_year": _with("""
select id_mutation, cast(year(cast(date_mutation as date)) as integer) annee from clean""", "clean"),
        "int_round": """
select l_orderkey, l_linenumber, cast(l_quantity / 2 as integer) half_even from lineitem""",
        "dim_lookup": _with(f"""
select c_custkey, c.code code_departement, coalesce(d.name, '') nom_departement
from (select c_custkey, {_department(_code('c_custkey'))} code from customer) c
left join departments d on d.code = c.code""", "departments(code, name)"),
        "slugify": f"select doc_id, {_slug('text')} slug from documents",
        "usable_sales": _with("""
select id_mutation, id_parcelle, type_local, valeur_fonciere, surface_reelle_bati from usable""", "usable"),
        "sales_by_dept": _with(f"""
select id_mutation, id_parcelle, code_departement from sales
where code_departement = '{DEPARTMENT}' or code_departement is null""", "sales"),
        "certificates_by_dept": _with(f"""
select numero_dpe, code_insee from certificates where {in_department}""", "certificates"),
        "certificates_by_postcode": _with(f"""
select numero_dpe, code_postal from certificates where code_postal = '{POSTCODE}'""", "certificates"),
        "communes_by_dept": _with(f"""
select code_insee, slug, code_departement, nom_departement from built
where code_departement = '{COMMUNE_DEPARTMENT}'""", "built"),
        "sales_last_n_years": _with(f"""
select id_mutation, id_parcelle, annee_fichier from sales where annee_fichier in (
  select distinct annee_fichier from sales order by annee_fichier desc limit {LATEST})""", "sales"),
        "missing_years": _with(f"""
select y annee from ({years}) r where y not in (select annee_fichier from sales)""", "sales"),
        "multi_parcel_deeds": _with("select id_mutation from multi", "multi"),
        "single_parcel_sales": _with("""
select id_mutation, id_parcelle, type_local, valeur_fonciere from clean""", "clean"),
        "clean_sales": _with("select * from clean", "clean"),
        "sales_funnel": _with("""
select * exclude (annee_fichier) from funnel_all where annee_fichier is null""", "funnel_all"),
        "sales_funnel_total": _with("select * from funnel_all", "funnel_all"),
        "check_retention_band": _with("""
select taux_retention_pct, case when taux_retention_pct < 40 or taux_retention_pct > 70 then 'warn' else 'ok' end statut
from funnel_all where annee_fichier is null""", "funnel_all"),
        "agg_commune_immo": _with("select * from immo", "immo"),
        "agg_commune_dpe": _with("select * from energy", "energy"),
        "agg_street": _with("""
select id_voie, nb_ventes, cast(m as integer) prix_m2_median, derniere_vente
from (select id_voie, count(*) nb_ventes, median(valeur_fonciere / surface_reelle_bati) m,
    max(cast(date_mutation as date)) derniere_vente
  from clean where id_voie is not null and surface_reelle_bati > 0 group by id_voie) g""", "clean"),
        "price_by_energy_class": _with("""
select code_insee, type_local, classe_dpe, nb_observations, cast(m as integer) prix_m2_median
from (select s.code_commune code_insee, type_local, classe_dpe, count(*) nb_observations,
    median(valeur_fonciere / surface_reelle_bati) m
  from clean s join certificates c on s.id_mutation = c.numero_dpe
  where surface_reelle_bati > 0 and classe_dpe in ('A', 'B', 'C', 'D', 'E', 'F', 'G') group by 1, 2, 3) g""",
            "clean", "certificates"),
        "eligible_communes": _with("select code_insee, nom from eligible", "eligible"),
        "communes_union_districts": _with("""
select typecom "TYPECOM", com "COM", libelle "LIBELLE" from cog where typecom = 'COM'
union all select typecom, com, libelle from cog where typecom = 'ARM'""", "cog"),
        "dedupe_slugs": """
select p_partkey, case when n = 0 then s else s || '-' || n end slug
from (select p_partkey, s, row_number() over (partition by s order by p_partkey) - 1 n
  from (select p_partkey, replace(p_name, ' ', '-') s from part) a) b""",
        "communes_build": _with("select * from built", "built"),
        "first_non_null": _with("""
select code_insee, cast(latitude as varchar) latitude, cast(longitude as varchar) longitude from found""",
            "found"),
        "commune_coordinates": _with("""
select c.code_insee, c.nom, c.code_departement, f.latitude, f.longitude
from communes c left join found f on f.code_insee = c.code_insee""", "communes", "found"),
        "communes_profile": _with("""
select count(*) communes, count(distinct slug) slugs_uniques, count(f.latitude) avec_coordonnees
from built b left join found f on f.code_insee = b.code_insee""", "built", "found"),
        "check_slug_unique": """
select replace(p_name, ' ', '-') slug, count(*) nb from part group by 1 having count(*) > 1""",
        "check_price_bounds": _with(f"""
select code_insee, annee, type_local, prix_m2_median from immo
where prix_m2_median < {PRICE_BOUNDS[0]} or prix_m2_median > {PRICE_BOUNDS[1]}""", "immo"),
        "check_share_bounds": _with(f"""
select code_insee, classe_dpe, part_pct from energy
where part_pct < {SHARE_BOUNDS[0]} or part_pct > {SHARE_BOUNDS[1]}""", "energy"),
        "check_share_sum": _with(f"""
select code_insee, round(sum(part_pct), 1) total from energy
group by code_insee having abs(sum(part_pct) - 100) > {SHARE_SLACK}""", "energy"),
        "orphan_communes": _with("""
select i.code_insee from immo i left join communes c on i.code_insee = c.code_insee
where c.code_departement is null""", "immo", "communes"),
        "quality_report": _with("""
select controle, lignes, case when lignes > 0 then 'ko' else 'ok' end statut from (
  select 'prix_m2_bornes' controle, count(*) lignes from immo where prix_m2_median < 100 or prix_m2_median > 40000
  union all select 'part_pct_bornes', count(*) from energy where part_pct < 0 or part_pct > 100
  union all select 'part_pct_somme', count(*) from (
    select code_insee from energy group by code_insee having abs(sum(part_pct) - 100) > 0.5) s
  union all select 'communes_departement', count(*) from immo i left join communes c
    on i.code_insee = c.code_insee where c.code_departement is null) q""", "immo", "energy", "communes"),
    }
