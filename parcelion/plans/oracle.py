"""SQL counterparts of the registered queries, for an independent engine.

Each statement starts from the same test tables and repeats the layers as common table
expressions. Iterative and random operators have no counterpart here.
"""

from __future__ import annotations

from parcelion.operators.boosting import TIE, Settings
from parcelion.plans.queries import COMMUNE, CUBE_YEAR, FOLD_MEASURES, MEASURES, POSTAL_CODE, PROJECTION_YEAR

ORACLE: dict[str, str] = {}


def even(expression: str, digits: int = 0) -> str:
    """Round with ties to even, without -0.0."""
    if digits == 0:
        return f"(round_even({expression}, 0) + 0.0::DOUBLE)"
    scale = f"{10**digits}::DOUBLE"
    return f"(round_even(({expression}) * {scale}, 0) / {scale} + 0.0::DOUBLE)"


def hex_number(digest: str, start: int) -> str:
    """Four hex digits as a number."""
    return " + ".join(
        f"(instr('0123456789abcdef', substr({digest}, {start + i}, 1)) - 1) * {16 ** (3 - i)}"
        for i in range(4)
    )


def lot(identity: str) -> str:
    decile = f"(({hex_number(f'sha256({identity} || chr(58) || chr(52) || chr(50))', 1)}) * 10 // 65536)"
    return f"CASE WHEN {decile} < 8 THEN 'train' WHEN {decile} = 8 THEN 'val' ELSE 'test' END"


def pad5(text: str) -> str:
    return f"CASE WHEN length({text}) < 5 THEN lpad({text}, 5, '0') ELSE {text} END"


_STATS = ", ".join(
    [
        "count(*) AS n", "avg({v}) AS mean", "stddev_samp({v}) AS std", "min({v}) AS lo", "max({v}) AS hi",
        "quantile_cont({v}, 0.25) AS q1", "quantile_cont({v}, 0.5) AS q2", "quantile_cont({v}, 0.75) AS q3",
    ]
)

LAYERS = f"""
WITH fields AS (
  SELECT CASE WHEN l_linenumber = 6 AND l_partkey % 40 = 0 THEN 'inconnue'
              ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_mutation,
         o_orderpriority AS nature_mutation,
         CASE WHEN l_linenumber = 7 THEN NULL
              WHEN l_linenumber = 5 AND l_partkey % 20 = 0 THEN '470000.00'
              WHEN l_linenumber = 5 AND l_partkey % 20 = 5 THEN '1300000.00'
              WHEN l_linenumber = 5 AND l_partkey % 20 = 10 THEN '600000000.00'
              ELSE CAST(CAST(l_extendedprice * 20 AS DECIMAL(12,2)) AS VARCHAR) END AS valeur_fonciere,
         CAST(1000 + c_nationkey * 1000 + c_custkey % 90 AS VARCHAR) AS code_postal,
         n_name || '-' || CAST(c_custkey % 10 AS VARCHAR) AS commune,
         CASE WHEN p_size % 7 = 0 THEN '' ELSE p_type END AS type_local,
         CASE WHEN p_size < 10 THEN NULL
              ELSE CAST(CAST(l_quantity * 5 AS DECIMAL(12,2)) AS VARCHAR) END AS surface_reelle_bati,
         CASE WHEN p_size < 10 THEN NULL ELSE CAST(p_size % 8 AS INTEGER) END AS nombre_pieces_principales,
         'mutations-' || CAST(year(o_orderdate) AS VARCHAR) AS fichier_source
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
),
typed AS (
  SELECT CAST(try_strptime(date_mutation, '%d/%m/%Y') AS DATE) AS date_mutation, nature_mutation,
         CAST(CAST(valeur_fonciere AS FLOAT) AS DOUBLE) AS valeur_fonciere, code_postal, commune, type_local,
         CAST(CAST(surface_reelle_bati AS FLOAT) AS DOUBLE) AS surface_reelle_bati,
         nombre_pieces_principales, fichier_source
  FROM fields
),
bronze AS (
  SELECT * REPLACE (coalesce(valeur_fonciere, 0) AS valeur_fonciere,
                    coalesce(surface_reelle_bati, 0) AS surface_reelle_bati,
                    coalesce(nombre_pieces_principales, 0) AS nombre_pieces_principales)
  FROM typed
),
dated AS (SELECT * FROM bronze WHERE date_mutation IS NOT NULL),
three_years AS (
  SELECT * FROM dated WHERE date_mutation >= DATE '1996-01-01' AND date_mutation < DATE '1999-01-01'
),
kept AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (
             PARTITION BY date_mutation, code_postal, valeur_fonciere, commune, type_local
             ORDER BY nature_mutation, surface_reelle_bati, nombre_pieces_principales, fichier_source
           ) AS place
    FROM dated)
  WHERE place = 1
),
silver AS (
  SELECT *, DATE '2025-01-01' AS part_date,
         sha256(concat_ws('||', CAST(date_mutation AS VARCHAR), code_postal,
                          CASE WHEN valeur_fonciere = 600000000 THEN '6.0E8' ELSE CAST(valeur_fonciere AS VARCHAR) END,
                          commune, type_local)) AS id_unique
  FROM kept
),
d_commune AS (
  SELECT CAST(row_number() OVER (ORDER BY commune) AS INTEGER) AS id_commune, commune AS nom_commune
  FROM (SELECT DISTINCT commune FROM silver WHERE commune IS NOT NULL)
),
d_type AS (
  SELECT CAST(row_number() OVER (ORDER BY type_local) AS INTEGER) AS id_type, type_local
  FROM (SELECT DISTINCT type_local FROM silver WHERE type_local IS NOT NULL)
),
d_nature AS (
  SELECT CAST(row_number() OVER (ORDER BY nature_mutation) AS INTEGER) AS id_nature, nature_mutation
  FROM (SELECT DISTINCT nature_mutation FROM silver WHERE nature_mutation IS NOT NULL)
),
fact AS (
  SELECT sha256('t:' || id_unique) AS id_transaction, id_unique, code_postal, date_mutation, fichier_source,
         part_date, valeur_fonciere, surface_reelle_bati, nombre_pieces_principales, id_commune, id_type, id_nature
  FROM silver s
  JOIN d_commune c ON s.commune = c.nom_commune
  JOIN d_type t ON s.type_local = t.type_local
  JOIN d_nature n ON s.nature_mutation = n.nature_mutation
),
g AS (
  SELECT commune, coalesce(nullif(nature_mutation, ''), 'Inconnue') AS nature,
         coalesce(nullif(type_local, ''), 'Inconnu') AS type,
         CAST(date_mutation AS VARCHAR) AS date, valeur_fonciere AS valeur, id_unique AS id
  FROM silver
  WHERE commune <> '' AND date_mutation IS NOT NULL AND valeur_fonciere <> 0
),
g_nt AS (SELECT DISTINCT nature, type FROM g),
g_tc AS (SELECT DISTINCT type, commune FROM g),
g_path AS (
  SELECT a.nature, a.type, b.commune, m.id, m.date, m.valeur
  FROM g_nt a JOIN g_tc b ON a.type = b.type JOIN g m ON b.commune = m.commune
),
bounds AS (
  SELECT * FROM (VALUES (1, 10000.0, 470000.0), (2, 470000.0, 1300000.0), (3, 1300000.0, 2000000.0)) t(segment, low, high)
),
first_cut AS (SELECT * FROM silver WHERE valeur_fonciere <= 500000000),
cut AS (SELECT * FROM silver WHERE valeur_fonciere <= 2000000),
seg AS (
  SELECT c.*, CAST(b.segment AS INTEGER) AS segment FROM cut c JOIN bounds b ON c.valeur_fonciere BETWEEN b.low AND b.high
),
iqr AS (
  SELECT segment, q1 - 1.5::DOUBLE * (q3 - q1) AS borne_inf, q3 + 1.5::DOUBLE * (q3 - q1) AS borne_sup
  FROM (SELECT segment, quantile_cont(surface_reelle_bati, 0.25) AS q1, quantile_cont(surface_reelle_bati, 0.75) AS q3
        FROM seg GROUP BY segment)
),
ranged AS (
  SELECT s.* FROM seg s JOIN iqr i ON s.segment = i.segment
  WHERE s.surface_reelle_bati BETWEEN borne_inf AND borne_sup
),
tidy AS (SELECT * FROM ranged WHERE surface_reelle_bati <> 0),
geo AS (
  SELECT * REPLACE ({pad5('code_postal')} AS code_postal), substr({pad5('code_postal')}, 1, 2) AS departement FROM tidy
),
dept AS (
  SELECT segment, departement, count(*) AS valeur_fonciere_count,
         {even('avg(valeur_fonciere)')} AS valeur_fonciere_mean,
         {even('quantile_cont(valeur_fonciere, 0.5)')} AS valeur_fonciere_median,
         {even('stddev_samp(valeur_fonciere)')} AS valeur_fonciere_std,
         {even('avg(surface_reelle_bati)')} AS surface_reelle_bati_mean,
         {even('quantile_cont(surface_reelle_bati, 0.5)')} AS surface_reelle_bati_median
  FROM geo GROUP BY segment, departement
),
two AS (SELECT * FROM geo WHERE segment = 2),
roomy AS (
  SELECT *, CAST(year(date_mutation) AS INTEGER) AS annee, CAST(month(date_mutation) AS INTEGER) AS mois,
         CAST(dayofyear(date_mutation) AS INTEGER) AS jour_annee,
         CAST(date_diff('day', (SELECT min(date_mutation) FROM two), date_mutation) AS INTEGER) AS jours_depuis_debut,
         valeur_fonciere / surface_reelle_bati AS prix_m2,
         CASE WHEN surface_reelle_bati <= 50 THEN 'Très petit' WHEN surface_reelle_bati <= 100 THEN 'Petit'
              WHEN surface_reelle_bati <= 150 THEN 'Moyen' WHEN surface_reelle_bati <= 200 THEN 'Grand'
              ELSE 'Très grand' END AS categorie_surface,
         surface_reelle_bati / nombre_pieces_principales AS surface_par_piece,
         {lot('id_unique')} AS lot
  FROM two WHERE surface_reelle_bati > 0 AND nombre_pieces_principales > 0
),
d_full AS (
  SELECT departement,
         {even('avg(valeur_fonciere)', 2)} AS dept_valeur_fonciere_mean,
         {even('quantile_cont(valeur_fonciere, 0.5)', 2)} AS dept_valeur_fonciere_median,
         {even('stddev_samp(valeur_fonciere)', 2)} AS dept_valeur_fonciere_std,
         count(*) AS dept_valeur_fonciere_count,
         {even('avg(surface_reelle_bati)', 2)} AS dept_surface_reelle_bati_mean,
         {even('quantile_cont(surface_reelle_bati, 0.5)', 2)} AS dept_surface_reelle_bati_median
  FROM roomy GROUP BY departement
),
frame AS (
  SELECT r.*, d.* EXCLUDE (departement), type_local || '_' || categorie_surface AS type_local_x_surface_cat
  FROM roomy r LEFT JOIN d_full d ON r.departement = d.departement
),
d_train AS (
  SELECT departement, avg(valeur_fonciere) AS dept_mean_price,
         quantile_cont(valeur_fonciere, 0.5) AS dept_median_price, stddev_samp(valeur_fonciere) AS dept_std_price,
         count(*) AS dept_count_trans, avg(surface_reelle_bati) AS dept_mean_surface
  FROM roomy WHERE lot = 'train' GROUP BY departement
),
predicted AS (
  SELECT r.*, d.dept_mean_price * (1 + mois / 100.0::DOUBLE) AS valeur_fonciere_predite
  FROM roomy r JOIN d_train d ON r.departement = d.departement
)
"""


def sql(name: str, body: str) -> None:
    ORACLE[name] = f"{LAYERS}{body.strip()}"


# --- sources and messages ---------------------------------------------------------------

sql("raw_scan", "SELECT * EXCLUDE (fichier_source) FROM fields")
sql("raw_scan_chosen", """
SELECT nature_mutation, type_local, count(*) AS lignes, count(valeur_fonciere) AS avec_valeur
FROM fields WHERE fichier_source IN ('mutations-1996', 'mutations-1998') GROUP BY 1, 2""")
sql("message_rows", "SELECT * FROM fields")
sql("message_json", """
SELECT CAST(to_json(struct_pack(date_mutation := date_mutation, nature_mutation := nature_mutation,
  valeur_fonciere := valeur_fonciere, code_postal := code_postal, commune := commune, type_local := type_local,
  surface_reelle_bati := surface_reelle_bati, nombre_pieces_principales := nombre_pieces_principales,
  fichier_source := fichier_source)) AS VARCHAR) AS value FROM fields""")
sql("message_parsed", """
SELECT * REPLACE (CAST(nombre_pieces_principales AS VARCHAR) AS nombre_pieces_principales) FROM fields""")
sql("message_quarantine", """
SELECT CASE WHEN type_local = '' THEN 'rejetes' ELSE 'lus' END AS etat, count(*) AS nb FROM fields GROUP BY 1""")
sql("source_counts", """
SELECT fichier_source, count(*) AS lignes, count(*) - count(valeur_fonciere) AS sans_valeur,
       count(*) - count(surface_reelle_bati) AS sans_surface,
       count(*) - count(nombre_pieces_principales) AS sans_pieces
FROM fields GROUP BY 1""")

# --- bronze and silver ------------------------------------------------------------------

sql("bronze_rows", "SELECT * FROM bronze")
sql("bronze_undated", "SELECT count(*) AS lignes, count(*) - count(date_mutation) AS sans_date FROM bronze")
sql("bronze_appended", "SELECT fichier_source, 2 * count(*) AS lignes FROM bronze GROUP BY 1")
sql("defaults_filled", """
SELECT date_mutation, commune, valeur_fonciere, surface_reelle_bati, nombre_pieces_principales FROM bronze""")
sql("dates_repaired", """
SELECT count(*) FILTER (type_local <> '' AND date_mutation <> 'inconnue') AS modifies,
       count(*) FILTER (type_local = '' OR date_mutation = 'inconnue') AS ignores FROM fields""")
sql("silver_rows", """
SELECT * FROM silver WHERE date_mutation >= DATE '1996-01-01' AND date_mutation < DATE '1999-01-01'""")
sql("silver_duplicates", """
SELECT annee, lignes, gardees
FROM (SELECT CAST(year(date_mutation) AS INTEGER) AS annee, count(*) AS lignes FROM three_years GROUP BY 1)
JOIN (SELECT CAST(year(date_mutation) AS INTEGER) AS annee, count(*) AS gardees FROM silver GROUP BY 1) USING (annee)""")
sql("silver_months", """
SELECT * FROM silver WHERE date_mutation >= DATE '1997-03-01' AND date_mutation < DATE '1997-06-01'""")
sql("silver_preview", "SELECT * FROM silver ORDER BY id_unique LIMIT 20")
sql("silver_csv", "SELECT * FROM silver")
sql("parquet_sample", f"""
SELECT count(*) AS total, count(DISTINCT commune) AS communes_uniques, {even('avg(valeur_fonciere)', 2)} AS valeur_moyenne
FROM (SELECT * FROM silver WHERE ({hex_number("sha256(id_unique || ':42')", 1)}) < 6553.6 ORDER BY sha256(id_unique || ':42'), id_unique LIMIT 20000)""")

# --- gold -------------------------------------------------------------------------------

sql("dim_communes", "SELECT * FROM d_commune")
sql("dim_types", "SELECT * FROM d_type")
sql("dim_natures", "SELECT * FROM d_nature")
sql("gold_transactions", "SELECT * FROM fact")
sql("gold_detail", """
SELECT id_transaction, code_postal, nom_commune, date_mutation, fichier_source, part_date, valeur_fonciere,
       surface_reelle_bati, nombre_pieces_principales, type_local, nature_mutation
FROM fact JOIN d_commune USING (id_commune) JOIN d_type USING (id_type) JOIN d_nature USING (id_nature)""")
sql("gold_stats_par_commune", f"""
SELECT nom_commune, count(*) AS nb_transactions, {even('avg(valeur_fonciere)')} AS valeur_moyenne,
       {even('sum(surface_reelle_bati)')} AS surface_totale
FROM fact JOIN d_commune USING (id_commune) GROUP BY 1""")
sql("gold_stats_par_type", f"""
SELECT type_local, count(*) AS nb_ventes, {even('avg(valeur_fonciere)')} AS prix_moyen
FROM fact JOIN d_type USING (id_type) GROUP BY 1""")
sql("gold_view", """
SELECT type_local, nature_mutation, count(*) AS nb, sum(valeur_fonciere) AS total
FROM fact JOIN d_type USING (id_type) JOIN d_nature USING (id_nature) GROUP BY 1, 2""")
sql("gold_integrity", """
SELECT 'communes.id_commune unique' AS regle, count(*) - count(DISTINCT id_commune) AS violations FROM d_commune
UNION ALL SELECT 'communes.nom_commune unique', count(*) - count(DISTINCT nom_commune) FROM d_commune
UNION ALL SELECT 'transactions.id_commune exists', count(DISTINCT id_commune) FROM fact WHERE id_commune NOT IN (SELECT id_commune FROM d_commune)
UNION ALL SELECT 'types_locaux.id_type unique', count(*) - count(DISTINCT id_type) FROM d_type
UNION ALL SELECT 'types_locaux.type_local unique', count(*) - count(DISTINCT type_local) FROM d_type
UNION ALL SELECT 'transactions.id_type exists', count(DISTINCT id_type) FROM fact WHERE id_type NOT IN (SELECT id_type FROM d_type)
UNION ALL SELECT 'natures_mutation.id_nature unique', count(*) - count(DISTINCT id_nature) FROM d_nature
UNION ALL SELECT 'natures_mutation.nature_mutation unique', count(*) - count(DISTINCT nature_mutation) FROM d_nature
UNION ALL SELECT 'transactions.id_nature exists', count(DISTINCT id_nature) FROM fact WHERE id_nature NOT IN (SELECT id_nature FROM d_nature)
UNION ALL SELECT 'transactions.id_transaction unique', count(*) - count(DISTINCT id_transaction) FROM fact""")
sql("cube_ventes", """
SELECT type_local, commune, CAST(year(date_mutation) AS INTEGER) AS annee, count(*) AS nb_ventes,
       sum(valeur_fonciere) AS total_valeur_fonciere, avg(surface_reelle_bati) AS surface_moyenne
FROM silver GROUP BY 1, 2, 3""")
sql("cube_par_commune_annee", f"""
SELECT commune, sum(valeur_fonciere) AS total_valeur_fonciere FROM silver
WHERE year(date_mutation) = {CUBE_YEAR} GROUP BY 1""")

# --- key figures, profile, lookup -------------------------------------------------------

_TOP5 = "SELECT commune, count(*) AS nb FROM bronze GROUP BY 1 ORDER BY nb DESC, commune LIMIT 5"
sql("kpi_headline", f"""
SELECT count(*) AS total_documents, {even('coalesce(avg(valeur_fonciere), 0)', 2)} AS moyenne_valeur_fonciere FROM bronze""")
sql("kpi_top5", _TOP5)
sql("kpi_key_values", f"""
SELECT 'stat_total_documents' AS key, 0::INTEGER AS pos, CAST(count(*) AS VARCHAR) AS value FROM bronze
UNION ALL SELECT 'stat_moyenne_valeur_fonciere', 0, CAST({even('avg(valeur_fonciere)', 2)} AS VARCHAR) FROM bronze
UNION ALL SELECT 'last_update_stats', 0, '2025-07-01 12:00:00'
UNION ALL SELECT 'top_communes', CAST(row_number() OVER (ORDER BY nb DESC, commune) - 1 AS INTEGER),
  commune || ' (' || CAST(nb AS VARCHAR) || ')' FROM ({_TOP5})""")
sql("kpi_list", f"""
SELECT CAST(row_number() OVER (ORDER BY nb DESC, commune) - 1 AS INTEGER) AS pos, commune, nb FROM ({_TOP5})""")
sql("kpi_report", """
SELECT count(*) AS total, count(DISTINCT commune) AS communes_uniques, avg(valeur_fonciere) AS valeur_moyenne FROM bronze""")
_TYPES = {"date_mutation": "date", "valeur_fonciere": "float", "surface_reelle_bati": "float", "nombre_pieces_principales": "int"}
sql("profile_shape", "SELECT count(*) AS lignes, 9::BIGINT AS colonnes FROM typed")
sql("profile_head", "SELECT * FROM silver ORDER BY date_mutation, id_unique LIMIT 100")
sql("profile_columns", "\nUNION ALL ".join(
    f"SELECT '{c}' AS colonne, '{_TYPES.get(c, 'string')}' AS type, avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100 AS pct_nul FROM typed"
    for c in ["date_mutation", "nature_mutation", "valeur_fonciere", "code_postal", "commune", "type_local",
              "surface_reelle_bati", "nombre_pieces_principales", "fichier_source"]))
for _name, _column, _end in [
    ("frequent_communes", "commune", "ORDER BY effectif DESC, valeur LIMIT 10"),
    ("frequent_types", "type_local", ""),
    ("frequent_natures", "nature_mutation", ""),
]:
    sql(_name, f"SELECT {_column} AS valeur, count(*) AS effectif FROM silver GROUP BY 1 {_end}")
sql("lookup_postal_code", f"SELECT * FROM silver WHERE code_postal = '{POSTAL_CODE}' ORDER BY id_unique LIMIT 100")
sql("lookup_clustered", f"""
SELECT * FROM silver WHERE code_postal = '{POSTAL_CODE}' AND date_mutation >= DATE '1997-01-01' AND date_mutation < DATE '1997-04-01'""")
sql("lookup_indexed", "SELECT * FROM silver WHERE commune ILIKE '%ATION_1%-3%' ORDER BY id_unique LIMIT 100")
sql("names_indexed", "SELECT DISTINCT commune, code_postal FROM silver WHERE commune ILIKE '%tion_2_-%'")
sql("lookup_commune", "SELECT * FROM silver WHERE commune ILIKE '%ation_1%' ORDER BY id_unique LIMIT 100")

# --- graph ------------------------------------------------------------------------------

_NODE_COUNTS = """
SELECT 'nodes_nature' AS "table", count(DISTINCT nature) AS nombre FROM g
UNION ALL SELECT 'nodes_type', count(DISTINCT type) FROM g
UNION ALL SELECT 'nodes_commune', count(DISTINCT commune) FROM g
UNION ALL SELECT 'nodes_mutation', count(*) FROM g
UNION ALL SELECT 'a_pour_type', count(*) FROM g_nt
UNION ALL SELECT 'a_pour_lieu', count(*) FROM g_tc
UNION ALL SELECT 'a_enregistre', count(*) FROM g"""
sql("graph_nodes", _NODE_COUNTS)
sql("graph_merged", _NODE_COUNTS)
sql("graph_reloaded", _NODE_COUNTS)
sql("graph_wiped", f'SELECT "table", 0::BIGINT AS nombre FROM ({_NODE_COUNTS})')
sql("graph_edges_type", "SELECT * FROM g_nt")
sql("graph_edges_lieu", "SELECT * FROM g_tc")
sql("graph_mutations", "SELECT id, date, valeur FROM g")
sql("graph_path_type", """
SELECT * FROM g_path WHERE type = 'ECONOMY' ORDER BY nature, type, commune, date, id LIMIT 100""")
sql("graph_path_counts", """
SELECT nature, type, count(*) AS chemins, count(DISTINCT commune) AS communes FROM g_path GROUP BY 1, 2""")
sql("graph_path_nature_commune", f"""
SELECT * FROM g_path WHERE nature = '1-URGENT' AND commune = '{COMMUNE}' AND type <> 'Inconnu'
ORDER BY nature, type, commune, date, id LIMIT 100""")
sql("graph_sales_by_commune", """
SELECT commune AS "Commune", count(*) AS "NombreMutations" FROM g GROUP BY 1
ORDER BY count(*) DESC, commune LIMIT 100""")
sql("graph_commune_history", f"""
SELECT date AS "Date", valeur AS "Valeur" FROM g WHERE commune = '{COMMUNE}' ORDER BY date, valeur, id LIMIT 100""")
sql("graph_list_nodes", """
SELECT genre, nom FROM (
  SELECT DISTINCT 'NatureMutation' AS genre, nature AS nom FROM g UNION ALL SELECT DISTINCT 'TypeLocal', type FROM g
  UNION ALL SELECT DISTINCT 'Commune', commune FROM g UNION ALL SELECT 'Mutation', id FROM g)
ORDER BY genre, nom LIMIT 100""")

# --- exploration ------------------------------------------------------------------------

sql("outliers_above", """
SELECT 500000000.0::DOUBLE AS seuil, count(*) FILTER (valeur_fonciere > 500000000) AS nb FROM silver
UNION ALL SELECT 2000000.0, count(*) FILTER (valeur_fonciere > 2000000) FROM silver""")
sql("segment_counts", "SELECT segment, count(*) AS lignes FROM seg GROUP BY 1")
sql("segment_iqr_bounds", "SELECT * FROM iqr")
sql("segment_cleaning", """
SELECT s.segment, count(*) AS lignes,
  count(*) FILTER (surface_reelle_bati BETWEEN borne_inf AND borne_sup) AS dans_bornes,
  count(*) FILTER (surface_reelle_bati BETWEEN borne_inf AND borne_sup AND surface_reelle_bati = 0) AS sans_surface,
  count(*) FILTER (surface_reelle_bati BETWEEN borne_inf AND borne_sup AND surface_reelle_bati <> 0) AS gardees
FROM seg s JOIN iqr i ON s.segment = i.segment GROUP BY 1""")
sql("segment_rows", "SELECT id_unique, segment, surface_reelle_bati FROM tidy")
sql("segment_summary", f"""
SELECT segment, count(*) AS nombre, avg(valeur_fonciere) AS prix_moyen,
       quantile_cont(valeur_fonciere, 0.5) AS prix_median, {even('stddev_samp(valeur_fonciere)', 2)} AS ecart_type,
       avg(surface_reelle_bati) AS surface_moyenne
FROM tidy GROUP BY 1""")


def _pivoted(label: str, expression: str) -> str:
    cells = ", ".join(
        f"{even(f'({expression}) FILTER (segment = {s})')} AS segment_{s}" for s in (1, 2, 3)
    )
    return f"SELECT '{label}' AS indicateur, {cells} FROM tidy"


sql("segment_table", "\nUNION ALL ".join([
    _pivoted("Nombre de transactions", "count(*)").replace("round_even((count(*))", "round_even(count(*)"),
    _pivoted("Prix moyen (€)", "avg(valeur_fonciere)"),
    _pivoted("Prix médian (€)", "quantile_cont(valeur_fonciere, 0.5)"),
    _pivoted("Écart-type prix", "stddev_samp(valeur_fonciere)"),
    _pivoted("Surface moyenne (m²)", "avg(surface_reelle_bati)"),
]).replace("((", "(").replace(")) FILTER", ") FILTER"))
sql("segment_price_m2", f"""
SELECT segment, {even('avg(valeur_fonciere / surface_reelle_bati)', 4)} AS prix_m2_moyen FROM tidy GROUP BY 1""")
sql("yearly_mean", """
SELECT segment, CAST(year(date_mutation) AS INTEGER) AS annee, avg(valeur_fonciere) AS prix_moyen FROM tidy GROUP BY 1, 2""")
sql("monthly_mean", """
SELECT segment, CAST(month(date_mutation) AS INTEGER) AS mois, avg(valeur_fonciere) AS prix_moyen FROM tidy GROUP BY 1, 2""")
sql("dept_stats", "SELECT * FROM dept")
for _name, _by, _rows in [("dept_top10", "valeur_fonciere_count", 10), ("dept_top15_mean", "valeur_fonciere_mean", 15)]:
    sql(_name, f"""
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY segment ORDER BY {_by} DESC, departement) AS INTEGER) AS rang FROM dept)
WHERE rang <= {_rows}""")
sql("dept_extremes", """
SELECT segment, count(*) AS departements, max(plus_cher) AS plus_cher, max(valeur_fonciere_mean) AS prix_plus_cher,
       max(moins_cher) AS moins_cher, min(valeur_fonciere_mean) AS prix_moins_cher
FROM (SELECT *,
        first_value(departement) OVER (PARTITION BY segment ORDER BY valeur_fonciere_mean DESC, departement) AS plus_cher,
        first_value(departement) OVER (PARTITION BY segment ORDER BY valeur_fonciere_mean, departement) AS moins_cher
      FROM dept) GROUP BY 1""")
sql("dept_common", """
SELECT departement FROM geo WHERE segment = 1 INTERSECT SELECT departement FROM geo WHERE segment = 2
INTERSECT SELECT departement FROM geo WHERE segment = 3""")
sql("dept_common_prices", """
SELECT a.departement, a.valeur_fonciere_mean AS prix_standard, b.valeur_fonciere_mean AS prix_haut_gamme,
       c.valeur_fonciere_mean AS prix_ultra
FROM dept a JOIN dept b ON a.departement = b.departement AND b.segment = 2
JOIN dept c ON a.departement = c.departement AND c.segment = 3
WHERE a.segment = 1 ORDER BY a.departement LIMIT 10""")
sql("dept_covered", """
SELECT segment, count(DISTINCT departement) AS departements, avg(valeur_fonciere) AS prix_moyen_national FROM geo GROUP BY 1""")


def _histogram(source: str, keys: str, value: str, bins: int, digits: int | None = None) -> str:
    by = f"{keys}, " if keys else ""
    over = f"PARTITION BY {keys}" if keys else ""
    ends = [even("mn", digits), even("mx", digits)] if digits else ["mn", "mx"]
    return f"""
SELECT {by}CAST(i - (v < i * step + mn)::INT + (i <> {bins - 1} AND v >= (i + 1) * step + mn)::INT AS INTEGER) AS classe,
       {ends[0].replace('mn', 'min(mn)')} AS borne_min, {ends[1].replace('mx', 'max(mx)')} AS borne_max, count(*) AS effectif
FROM (SELECT *, least(floor((v - mn) / (mx - mn) * {bins}), {bins - 1}) AS i, (mx - mn) / {bins} AS step
      FROM (SELECT {by}{value} AS v, min({value}) OVER ({over}) AS mn, max({value}) OVER ({over}) AS mx FROM {source}))
GROUP BY {by}2""" if keys else f"""
SELECT CAST(i - (v < i * step + mn)::INT + (i <> {bins - 1} AND v >= (i + 1) * step + mn)::INT AS INTEGER) AS classe,
       min(mn) AS borne_min, max(mx) AS borne_max, count(*) AS effectif
FROM (SELECT *, least(floor((v - mn) / (mx - mn) * {bins}), {bins - 1}) AS i, (mx - mn) / {bins} AS step
      FROM (SELECT {value} AS v, min({value}) OVER () AS mn, max({value}) OVER () AS mx FROM {source}))
GROUP BY 1"""


sql("histogram_100", _histogram("first_cut", "", "valeur_fonciere", 100))
sql("histogram_segment_50", _histogram("tidy", "segment", "valeur_fonciere", 50))
sql("histogram_surface", _histogram("ranged", "segment", "surface_reelle_bati", 100))
sql("histogram_log_price", _histogram("tidy", "segment", "ln(valeur_fonciere)", 50, 6))


def _box(source: str, keys: str, value: str) -> str:
    by = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    match = f"b.{keys} = s.{keys}" if keys else "true"
    select = f"s.{keys}, " if keys else ""
    return f"""
SELECT {select}max(n) AS n, max(q1) AS q1, max(q2) AS mediane, max(q3) AS q3,
  min({value}) FILTER ({value} >= q1 - 1.5::DOUBLE * (q3 - q1)) AS moustache_basse,
  max({value}) FILTER ({value} <= q3 + 1.5::DOUBLE * (q3 - q1)) AS moustache_haute,
  CAST(count(*) FILTER ({value} < q1 - 1.5::DOUBLE * (q3 - q1) OR {value} > q3 + 1.5::DOUBLE * (q3 - q1)) AS BIGINT) AS hors
FROM {source} s JOIN (SELECT {by}{_STATS.format(v=value)} FROM {source} {group}) b ON {match}
{f'GROUP BY s.{keys}' if keys else ''}"""


sql("box_price", _box("first_cut", "", "valeur_fonciere"))
sql("box_segment_price", _box("tidy", "segment", "valeur_fonciere"))
sql("box_surface", _box("cut", "", "surface_reelle_bati"))

_FIT = f"""
SELECT segment, {even('p', 3)} AS pente, {even('o', 3)} AS ordonnee, x_min, x_max,
       {even('p * x_min + o', 3)} AS y_min, {even('p * x_max + o', 3)} AS y_max
FROM (SELECT segment, regr_slope(valeur_fonciere, surface_reelle_bati) AS p,
             regr_intercept(valeur_fonciere, surface_reelle_bati) AS o,
             min(surface_reelle_bati) AS x_min, max(surface_reelle_bati) AS x_max FROM {{source}} GROUP BY 1)"""
_DIGEST = "sha256(id_unique || chr(58) || '42')"
sql("ols_surface_price", _FIT.format(source="tidy"))
sql("ols_on_sample", _FIT.format(source=f"""
(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY {_DIGEST}, id_unique) AS place FROM tidy)
 WHERE place <= 30000)"""))
sql("sample_rows", f"""
SELECT id_unique, commune, valeur_fonciere FROM silver ORDER BY {_DIGEST}, id_unique LIMIT 10000""")
# The skewness function of the other engine is bias-corrected; this is the population one.
_SKEW = "skewness(valeur_fonciere) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0::DOUBLE))"
sql("target_distribution", f"""
SELECT segment, count(*) AS n, min(valeur_fonciere) AS min, max(valeur_fonciere) AS max,
       quantile_cont(valeur_fonciere, 0.5) AS mediane, {even('stddev_samp(valeur_fonciere)', 2)} AS ecart_type,
       {even(_SKEW, 6)} AS asymetrie FROM tidy GROUP BY 1""")
sql("describe_columns", "\nUNION ALL ".join(f"""
SELECT '{c}' AS variable, n AS count, {even('mean', 2)} AS mean, {even('std', 2)} AS std, CAST(lo AS DOUBLE) AS min,
  q1 AS p25, q2 AS p50, q3 AS p75, CAST(hi AS DOUBLE) AS max
FROM (SELECT {_STATS.format(v=c)} FROM silver)"""
    for c in ["valeur_fonciere", "surface_reelle_bati", "nombre_pieces_principales"]))

# --- loads ------------------------------------------------------------------------------

_AFTER = """(SELECT * FROM silver WHERE date_mutation >= DATE '1996-01-01' AND date_mutation < DATE '1999-01-01'
  AND (year(date_mutation) <> 1997 OR (month(date_mutation) <> 6 AND (month(date_mutation) <> 7 OR valeur_fonciere > 500000))))"""
sql("silver_published", f"SELECT * FROM {_AFTER}")
sql("cube_incremental", f"""
SELECT type_local, commune, CAST(year(date_mutation) AS INTEGER) AS annee, count(*) AS nb_ventes,
  {even('sum(valeur_fonciere)', 2)} AS total_valeur_fonciere, {even('avg(surface_reelle_bati)', 2)} AS surface_moyenne FROM {_AFTER} GROUP BY 1, 2, 3""")
sql("load_refused", """
SELECT regle, violations, 0::BIGINT AS mois_publies FROM (
  SELECT 'id_unique unique' AS regle, count(*) FILTER (month(date_mutation) = 3) AS violations FROM silver WHERE valeur_fonciere < 100000
  UNION ALL SELECT 'commune not null', count(*) FILTER (month(date_mutation) = 1) FROM silver WHERE valeur_fonciere < 100000
  UNION ALL SELECT 'type_local exists', count(DISTINCT type_local) FILTER (month(date_mutation) = 2) FROM silver WHERE valeur_fonciere < 100000
) WHERE violations > 0""")
_SILVER_COLUMNS = (
    "date_mutation date, nature_mutation string, valeur_fonciere double, code_postal string, commune string, type_local string, "
    "surface_reelle_bati double, nombre_pieces_principales int, fichier_source string, part_date date, id_unique string"
)
sql("silver_schema", f"""
SELECT place, colonne, genre, (SELECT count(*) FROM silver) AS lignes
FROM (VALUES {', '.join("({}::INTEGER, '{}', '{}')".format(i, *c.split()) for i, c in enumerate(_SILVER_COLUMNS.split(', '), 1))}) t(place, colonne, genre)""")
sql("silver_empty_window", "SELECT count(*) AS lignes, count(DISTINCT id_unique) AS cles FROM silver WHERE year(date_mutation) = 1900")
_LOADED = {
    "nodes_nature": "SELECT DISTINCT nature FROM {g}", "nodes_type": "SELECT DISTINCT type FROM {g}", "nodes_commune": "SELECT DISTINCT commune FROM {g}",
    "nodes_mutation": "SELECT id FROM {g}", "a_pour_type": "SELECT DISTINCT nature, type FROM {g}", "a_pour_lieu": "SELECT DISTINCT type, commune FROM {g}",
    "a_enregistre": "SELECT commune, id FROM {g}",
}
_EARLY = "(SELECT * FROM g WHERE CAST(date AS DATE) < DATE '1997-01-01')"
sql("graph_load_counters", "\nUNION ALL ".join(
    f"SELECT '{name}' AS \"table\", a AS total, a AS charges, 0::BIGINT AS ignores, 1::INTEGER AS chargement FROM (SELECT count(*) AS a FROM ({body.format(g=_EARLY)}))"
    f" UNION ALL SELECT '{name}', b, b - a, a, 2 FROM (SELECT count(*) AS a FROM ({body.format(g=_EARLY)})), (SELECT count(*) AS b FROM ({body.format(g='g')}))"
    for name, body in _LOADED.items()))

# --- features ---------------------------------------------------------------------------

# All three segments, each with its own first day and department figures.
SEGMENTED = f""",
first_day AS (SELECT segment, min(date_mutation) AS d0 FROM geo GROUP BY 1),
roomy_by AS (
  SELECT g.*, CAST(year(date_mutation) AS INTEGER) AS annee, CAST(month(date_mutation) AS INTEGER) AS mois,
    CAST(date_diff('day', d0, date_mutation) AS INTEGER) AS jours_depuis_debut, valeur_fonciere / surface_reelle_bati AS prix_m2,
    CASE WHEN surface_reelle_bati <= 50 THEN 'Très petit' WHEN surface_reelle_bati <= 100 THEN 'Petit'
         WHEN surface_reelle_bati <= 150 THEN 'Moyen' WHEN surface_reelle_bati <= 200 THEN 'Grand' ELSE 'Très grand' END AS categorie_surface,
    surface_reelle_bati / nombre_pieces_principales AS surface_par_piece, {lot('id_unique')} AS lot,
    CAST(({hex_number(_DIGEST, 9)}) * 5 // 65536 AS INTEGER) AS pli
  FROM geo g JOIN first_day f ON g.segment = f.segment WHERE surface_reelle_bati > 0 AND nombre_pieces_principales > 0
),
full_by AS (
  SELECT segment, departement, {even('avg(valeur_fonciere)', 2)} AS dept_valeur_fonciere_mean,
    {even('quantile_cont(valeur_fonciere, 0.5)', 2)} AS dept_valeur_fonciere_median,
    {even('stddev_samp(valeur_fonciere)', 2)} AS dept_valeur_fonciere_std, count(*) AS dept_valeur_fonciere_count,
    {even('avg(surface_reelle_bati)', 2)} AS dept_surface_reelle_bati_mean,
    {even('quantile_cont(surface_reelle_bati, 0.5)', 2)} AS dept_surface_reelle_bati_median
  FROM roomy_by GROUP BY 1, 2
),
frame_by AS (
  SELECT r.*, d.* EXCLUDE (segment, departement), type_local || '_' || categorie_surface AS type_local_x_surface_cat
  FROM roomy_by r JOIN full_by d ON r.segment = d.segment AND r.departement = d.departement
),
scored_by AS (
  SELECT r.*, d.prediction FROM roomy_by r JOIN (
    SELECT segment, departement, avg(valeur_fonciere) AS prediction FROM roomy_by WHERE lot = 'train' GROUP BY 1, 2
  ) d ON r.segment = d.segment AND r.departement = d.departement WHERE lot <> 'train'
)
"""
sql("temporal_features", f"""{SEGMENTED}
SELECT segment, id_unique, CAST(year(d) AS INTEGER) AS annee, CAST(month(d) AS INTEGER) AS mois,
  CAST(quarter(d) AS INTEGER) AS trimestre, CAST(isodow(d) - 1 AS INTEGER) AS jour_semaine,
  CAST(dayofyear(d) AS INTEGER) AS jour_annee,
  {even('sin(2 * pi() * month(d) / 12)', 6)} AS mois_sin, {even('cos(2 * pi() * month(d) / 12)', 6)} AS mois_cos,
  {even('sin(2 * pi() * (isodow(d) - 1) / 7)', 6)} AS jour_semaine_sin,
  {even('cos(2 * pi() * (isodow(d) - 1) / 7)', 6)} AS jour_semaine_cos,
  CAST(date_diff('day', d0, d) AS INTEGER) AS jours_depuis_debut
FROM (SELECT g.segment, id_unique, date_mutation AS d, d0 FROM geo g JOIN first_day f ON g.segment = f.segment)""")
sql("surface_features", f"""{SEGMENTED}
SELECT segment, id_unique, prix_m2, categorie_surface, {even('ln(1 + surface_reelle_bati)', 6)} AS log_surface,
       surface_reelle_bati * surface_reelle_bati AS surface_squared, surface_par_piece FROM roomy_by""")
sql("geographic_features", f"""{SEGMENTED}
SELECT segment, id_unique, code_postal, departement, dept_valeur_fonciere_mean, dept_valeur_fonciere_median,
       dept_valeur_fonciere_std, dept_surface_reelle_bati_mean, dept_surface_reelle_bati_median,
       dept_valeur_fonciere_count, dept_valeur_fonciere_count AS dept_densite_transactions,
       {even('valeur_fonciere / dept_valeur_fonciere_mean', 6)} AS ratio_prix_dept FROM frame_by""")
sql("interaction_features", f"""{SEGMENTED}
SELECT segment, id_unique, annee * surface_reelle_bati AS annee_x_surface,
       {even('dept_valeur_fonciere_mean * surface_reelle_bati', 2)} AS dept_prix_x_surface, type_local_x_surface_cat
FROM frame_by""")
_NATURES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
sql("feature_frame", f"""{SEGMENTED}
SELECT segment, id_unique, lot, pli, mois, jours_depuis_debut, surface_par_piece, prix_m2, dept_valeur_fonciere_mean,
  CAST(dense_rank() OVER (PARTITION BY segment ORDER BY departement) - 1 AS INTEGER) AS departement_encoded, 0::INTEGER AS nature_mutation_nan,
  {', '.join(f"CAST(nature_mutation = '{n}' AS INTEGER) AS nature_mutation_{n.replace('-', '_').replace(' ', '_')}" for n in _NATURES)}
FROM frame_by""")
sql("one_hot", f"""{SEGMENTED}
SELECT segment, id_unique, {', '.join(f"CAST(categorie_surface = '{v}' AS INTEGER) AS {n}" for v, n in [
    ('Très petit', 'tres_petit'), ('Petit', 'petit'), ('Moyen', 'moyen'), ('Grand', 'grand'),
    ('Très grand', 'tres_grand')])}, 0::INTEGER AS manquant FROM frame_by""")
sql("label_codes", f"""{SEGMENTED}
SELECT segment, id_unique,
  CAST(dense_rank() OVER (PARTITION BY segment ORDER BY type_local_x_surface_cat) - 1 AS INTEGER) AS type_local_x_surface_cat_encoded,
  CAST(dense_rank() OVER (PARTITION BY segment ORDER BY departement) - 1 AS INTEGER) AS departement_encoded FROM frame_by""")
sql("train_dept_stats", f"""
SELECT departement, dept_count_trans, {', '.join(f"{even(c, 2)} AS {c}" for c in [
    'dept_mean_price', 'dept_median_price', 'dept_std_price', 'dept_mean_surface'])} FROM d_train""")
sql("safe_validation", f"""
SELECT id_unique, r.departement, {even('dept_mean_price', 4)} AS dept_mean_price,
       {even('valeur_fonciere / dept_mean_price', 4)} AS ratio_prix_dept
FROM roomy r LEFT JOIN d_train d ON r.departement = d.departement WHERE lot = 'val'""")
sql("split_lots", f"SELECT id_unique, {lot('id_unique')} AS lot FROM silver")
sql("split_folds", f"""
SELECT id_unique, CAST(({hex_number(_DIGEST, 9)}) * 5 // 65536 AS INTEGER) AS pli FROM silver""")
sql("date_parts", """
SELECT id_unique, CAST(year(date_mutation) AS INTEGER) AS date_mutation_year,
  CAST(month(date_mutation) AS INTEGER) AS date_mutation_month, CAST(day(date_mutation) AS INTEGER) AS date_mutation_day,
  CAST(isodow(date_mutation) - 1 AS INTEGER) AS date_mutation_dayofweek,
  CAST(quarter(date_mutation) AS INTEGER) AS date_mutation_quarter,
  CAST(epoch(date_mutation) AS BIGINT) AS date_mutation_timestamp FROM silver""")
sql("date_like_columns", """
SELECT 'date_texte' AS colonne, true AS date, count(date_mutation) AS lignes FROM silver
UNION ALL SELECT 'commune', false, count(commune) FROM silver
UNION ALL SELECT 'nature_mutation', false, count(nature_mutation) FROM silver""")
sql("dates_converted", ORACLE["date_parts"][len(LAYERS):].replace("date_mutation_", "date_texte_") if "date_parts" in ORACLE else "")
sql("projection_dates", f"""
SELECT id_unique, CAST(date_mutation + to_months(CAST(12 * ({PROJECTION_YEAR} - year(date_mutation)) AS INTEGER)) AS DATE) AS date_mutation,
       {PROJECTION_YEAR}::INTEGER AS annee, mois, departement
FROM roomy""")
sql("model_folds", f"""
SELECT lot, CAST(({hex_number("sha256(id_unique || ':42')", 9)}) * 5 // 65536 AS INTEGER) AS pli, count(*) AS lignes FROM roomy GROUP BY 1, 2""")
sql("year_moved", f"""
SELECT id_unique, CAST(date_mutation + to_months(CAST(12 * ({PROJECTION_YEAR} - year(date_mutation)) AS INTEGER)) AS DATE) AS date_projetee
FROM silver""")
sql("combined_common", """
SELECT segment, count(*) AS lignes, 11::INTEGER AS colonnes FROM tidy WHERE segment IN (1, 2) GROUP BY 1""")
sql("combined_all", """
SELECT segment, count(*) AS lignes, count(*) FILTER (segment = 2) AS extra,
  CAST(sum(CASE WHEN segment = 2 THEN nombre_pieces_principales ELSE 0 END) AS BIGINT) AS pieces
FROM tidy WHERE segment IN (1, 2) GROUP BY 1""")
sql("numbers_coerced", f"""
SELECT fichier_source, {even('sum(coalesce(CAST(valeur_fonciere AS DOUBLE), 0))', 2)} AS prix,
  sum(coalesce(CAST(surface_reelle_bati AS DOUBLE), 0)) AS surface, sum(CAST(code_postal AS DOUBLE)) AS codes,
  0.0::DOUBLE AS communes FROM fields GROUP BY 1""")
sql("gaps_imputed", f"""
SELECT fichier_source, count(*) AS lignes,
  {even('sum(coalesce(valeur_fonciere, (SELECT quantile_cont(valeur_fonciere, 0.5) FROM typed)))', 2)} AS prix,
  sum(coalesce(surface_reelle_bati, (SELECT quantile_cont(surface_reelle_bati, 0.5) FROM typed))) AS surface,
  sum(coalesce(CAST(nombre_pieces_principales AS DOUBLE),
               (SELECT quantile_cont(CAST(nombre_pieces_principales AS DOUBLE), 0.5) FROM typed))) AS pieces
FROM typed GROUP BY 1""")
sql("complete_rows", """
SELECT fichier_source, count(*) AS lignes FROM typed WHERE valeur_fonciere IS NOT NULL
  AND surface_reelle_bati IS NOT NULL AND nombre_pieces_principales IS NOT NULL GROUP BY 1""")


def _scaled(columns: list[str], centre: str, width: str) -> str:
    inner = ", ".join(
        f"{centre.format(v=c)} AS c_{i}, {width.format(v=c)} AS w_{i}" for i, c in enumerate(columns)
    )
    outer = ", ".join(
        f"{even(f'({c} - c_{i}) / (CASE WHEN w_{i} = 0 THEN 1 ELSE w_{i} END)', 6)} AS {c}"
        for i, c in enumerate(columns)
    )
    return f"SELECT id_unique, {outer} FROM frame JOIN (SELECT {inner} FROM frame WHERE lot = 'train') ON true"


_ROBUST = ["surface_reelle_bati", "jours_depuis_debut", "surface_par_piece"]
sql("robust_scaled", f"""{SEGMENTED}
SELECT f.segment, id_unique, {', '.join(
    f"{even(f'({c} - c_{c}) / (CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END)', 6)} AS {c}" for c in _ROBUST)}
FROM frame_by f JOIN (SELECT segment, {', '.join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS c_{c}, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.75) - quantile_cont(CAST({c} AS DOUBLE), 0.25) AS w_{c}" for c in _ROBUST)}
  FROM frame_by WHERE lot = 'train' GROUP BY 1) q ON f.segment = q.segment""")
sql("standard_scaled", _scaled(
    ["surface_reelle_bati", "jours_depuis_debut"], "avg({v})", "stddev_pop({v})"))


def _binned(column: str) -> str:
    cuts = " UNION ".join(f"SELECT quantile_cont(CAST({column} AS DOUBLE), {i / 10}) AS b FROM learn" for i in range(1, 10))
    return f"(SELECT count(*) FROM ({cuts}) WHERE l.{column} > b)"


sql("mutual_information", f""",
learn AS (SELECT * FROM frame WHERE lot = 'train'),
placed AS (
  SELECT variable, x, y, count(*) AS n FROM (
    {' UNION ALL '.join(f"SELECT '{c}' AS variable, {_binned(c)} AS x, {_binned('valeur_fonciere')} AS y FROM learn l" for c in ['surface_reelle_bati', 'prix_m2', 'jour_annee'])})
  GROUP BY 1, 2, 3)
SELECT variable, {even('sum(n / total * ln(n * total / (nx * ny)))', 6)} AS information
FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY variable) AS DOUBLE) AS total,
        sum(n) OVER (PARTITION BY variable, x) AS nx, sum(n) OVER (PARTITION BY variable, y) AS ny FROM placed)
GROUP BY 1""")

sql("prepared_lots", f"""
SELECT {lot('id_unique')} AS lot, count(*) AS lignes FROM geo
WHERE surface_reelle_bati > 0 AND nombre_pieces_principales > 0
GROUP BY 1""")

# --- models -----------------------------------------------------------------------------

_XY = "valeur_fonciere, surface_reelle_bati"
sql("linear_surface", f"""
SELECT segment, count(*) AS lignes, {even(f'regr_slope({_XY})', 2)} AS pente, {even(f'regr_intercept({_XY})', 1)} AS ordonnee
FROM tidy GROUP BY 1""")
sql("ridge_surface", f"""
SELECT segment, n AS lignes, {even('b', 2)} AS pente, {even('my - b * mx', 1)} AS ordonnee
FROM (SELECT segment, count(*) AS n, regr_sxy({_XY}) / (regr_sxx({_XY}) + 1000) AS b, avg(valeur_fonciere) AS my,
             avg(surface_reelle_bati) AS mx FROM tidy GROUP BY 1)""")
_E = "(valeur_fonciere - prediction)"
sql("baseline_metrics", f"""{SEGMENTED}
SELECT segment, lot, count(*) AS n, {even(f'avg({_E} * {_E})')} AS mse, {even(f'sqrt(avg({_E} * {_E}))', 4)} AS rmse,
  {even(f'avg(abs({_E}))', 4)} AS mae,
  {even(f'1 - sum({_E} * {_E}) / (count(*) * var_pop(valeur_fonciere))', 4)} AS r2,
  {even(f'avg(abs({_E} / valeur_fonciere)) * 100', 4)} AS mape FROM scored_by GROUP BY 1, 2""")
sql("baseline_residuals", f"""{SEGMENTED}
SELECT segment, lot, {even(f'avg({_E})', 2)} AS moyenne, {even(f'stddev_pop({_E})', 2)} AS ecart_type,
       {even(f'quantile_cont({_E}, 0.5)', 2)} AS mediane FROM scored_by GROUP BY 1, 2""")
sql("model_log_target", f"""
SELECT segment, {even('a', 6)} AS asymetrie, abs(a) > 1.5 AS log FROM (SELECT segment, {_SKEW} AS a FROM tidy GROUP BY 1)""")

# All three segments with their numeric features, for statements that go on with more tables.
ALL_FEATURES = f""",
first_days AS (SELECT segment, min(date_mutation) AS d0 FROM geo GROUP BY 1),
roomy_all AS (
  SELECT g.*, CAST(year(date_mutation) AS INTEGER) AS annee, CAST(month(date_mutation) AS INTEGER) AS mois,
    CAST(quarter(date_mutation) AS INTEGER) AS trimestre, CAST(isodow(date_mutation) - 1 AS INTEGER) AS jour_semaine,
    CAST(dayofyear(date_mutation) AS INTEGER) AS jour_annee, sin(2 * pi() * month(date_mutation) / 12) AS mois_sin,
    cos(2 * pi() * month(date_mutation) / 12) AS mois_cos, sin(2 * pi() * (isodow(date_mutation) - 1) / 7) AS jour_semaine_sin,
    cos(2 * pi() * (isodow(date_mutation) - 1) / 7) AS jour_semaine_cos, CAST(date_diff('day', d0, date_mutation) AS INTEGER) AS jours_depuis_debut,
    ln(1 + surface_reelle_bati) AS log_surface, surface_reelle_bati * surface_reelle_bati AS surface_squared,
    surface_reelle_bati / nombre_pieces_principales AS surface_par_piece, {lot('id_unique')} AS lot,
    CAST(({hex_number(_DIGEST, 9)}) * 5 // 65536 AS INTEGER) AS pli
  FROM geo g JOIN first_days f ON g.segment = f.segment WHERE surface_reelle_bati > 0 AND nombre_pieces_principales > 0
),
frame_all AS (
  SELECT r.*, annee * surface_reelle_bati AS annee_x_surface, d.* EXCLUDE (segment, departement)
  FROM roomy_all r JOIN (
    SELECT segment, departement, {even('avg(surface_reelle_bati)', 2)} AS dept_surface_reelle_bati_mean,
      {even('quantile_cont(surface_reelle_bati, 0.5)', 2)} AS dept_surface_reelle_bati_median, count(*) AS dept_valeur_fonciere_count
    FROM roomy_all GROUP BY 1, 2) d ON r.segment = d.segment AND r.departement = d.departement
)"""

# Normal equations by elimination without row changes: one step per column, all models at once.
def _vector(columns: list[str]) -> str:
    return f"[{', '.join(f'CAST({c} AS DOUBLE)' for c in columns)}]"


def _equations(count: int, learn: str) -> str:
    """``learn`` selects segment, pli and the vector v of ``count`` measures and the price."""
    return f"""{ALL_FEATURES},
learn AS ({learn}),
means AS (
  SELECT segment, list(m ORDER BY i) AS m, list(w ORDER BY i) AS w FROM (
    SELECT segment, i, avg(x) AS m, CASE WHEN quantile_cont(x, 0.75) = quantile_cont(x, 0.25) THEN 1.0::DOUBLE ELSE quantile_cont(x, 0.75) - quantile_cont(x, 0.25) END AS w
    FROM (SELECT segment, unnest(v) AS x, unnest(range(1, {count + 2})) AS i FROM learn) GROUP BY 1, 2) GROUP BY 1
),
shifted AS (
  SELECT l.segment, pli, list_concat([1.0::DOUBLE], [v[i] - m[i] FOR i IN range(1, {count + 2})]) AS z FROM learn l JOIN means ON l.segment = means.segment
),
cells AS (
  SELECT segment, pli, i, j, sum(a * b) AS s FROM (
    SELECT segment, pli, z, i, a, unnest(range(1, {count + 3})) AS j, unnest(z) AS b
    FROM (SELECT segment, pli, z, unnest(range(1, {count + 3})) AS i, unnest(z) AS a FROM shifted)
  ) WHERE i <= j GROUP BY 1, 2, 3, 4
),
models AS (SELECT segment, pli AS tenu FROM cells GROUP BY 1, 2 UNION ALL SELECT DISTINCT segment, -1 FROM cells),
sums AS (
  SELECT c.segment, tenu, i, j, sum(s) FILTER (pli <> tenu) AS s, sum(s) FILTER (pli = tenu) AS held
  FROM cells c JOIN models m ON c.segment = m.segment GROUP BY 1, 2, 3, 4
),
blocks AS (
  SELECT segment, tenu, list(line ORDER BY i) AS g, list(other ORDER BY i) AS h FROM (
    SELECT segment, tenu, i, list(s ORDER BY j) AS line, list(held ORDER BY j) AS other FROM (
      SELECT segment, tenu, i, j, s, held FROM sums UNION ALL SELECT segment, tenu, j, i, s, held FROM sums WHERE i < j
    ) GROUP BY 1, 2, 3
  ) GROUP BY 1, 2
),
alphas AS (SELECT * FROM (VALUES ('Linear Regression', 0.0::DOUBLE), ('Ridge', 1.0::DOUBLE)) t(modele, alpha)),
solved AS (
  SELECT b.segment, tenu, modele, 0 AS k, g, h,
    [[(g[i][j] - g[1][i] * g[1][j] / g[1][1] + CASE WHEN i = j THEN alpha * w[i - 1] * w[i - 1] ELSE 0 END)
      / (w[i - 1] * CASE WHEN j = {count + 2} THEN 1 ELSE w[j - 1] END) FOR j IN range(2, {count + 3})] FOR i IN range(2, {count + 2})] AS a
  FROM blocks b JOIN means ON b.segment = means.segment, alphas
  UNION ALL
  SELECT segment, tenu, modele, k + 1, g, h,
    [CASE WHEN i = k + 1 THEN [x / a[k + 1][k + 1] FOR x IN a[i]] ELSE [a[i][j] - a[i][k + 1] * a[k + 1][j] / a[k + 1][k + 1] FOR j IN range(1, {count + 2})] END FOR i IN range(1, {count + 1})]
  FROM solved WHERE k < {count}
),
fitted AS (
  SELECT s.segment, tenu, modele, g, h, m, [a[i][{count + 1}] / w[i] FOR i IN range(1, {count + 1})] AS b FROM solved s JOIN means ON s.segment = means.segment WHERE k = {count}
),
complete AS (
  SELECT *, g[1][{count + 2}] / g[1][1] - list_sum([b[i] * g[1][i + 1] / g[1][1] FOR i IN range(1, {count + 1})]) AS b0 FROM fitted
)"""


_COUNT = len(MEASURES)
_EQUATIONS = _equations(_COUNT, f"SELECT segment, pli, {_vector([*MEASURES, 'valeur_fonciere'])} AS v FROM frame_all WHERE lot = 'train'")


def _significant(value: str, digits: int) -> str:
    power = f"(floor(log10(abs({value}))) - {digits - 1})"
    scale = f"pow(10.0::DOUBLE, abs({power}))"
    return f"""CASE WHEN {value} = 0 THEN 0.0::DOUBLE WHEN {power} > 0 THEN round_even({value} / {scale}, 0) * {scale}
      ELSE round_even({value} * {scale}, 0) / {scale} END"""


def _recursive(name: str, body: str) -> None:
    ORACLE[name] = f"{LAYERS.replace('WITH', 'WITH RECURSIVE', 1)}{body.strip()}"


_recursive("linear_coefficients", f"""{_EQUATIONS}
SELECT segment, modele, variable, {_significant('c', 5)} AS coefficient FROM (
  SELECT segment, modele, unnest([{', '.join(f"'{c}'" for c in ['constante', *MEASURES])}]) AS variable,
    unnest(list_concat([b0 + m[{_COUNT + 1}] - list_sum([b[i] * m[i] FOR i IN range(1, {_COUNT + 1})])], b)) AS c
  FROM complete WHERE tenu = -1)""")


def _errors(count: int) -> str:
    return f"""
sides AS (SELECT *, list_concat([-b0], [-x FOR x IN b], [1.0::DOUBLE]) AS v FROM complete WHERE tenu >= 0),
errors AS (
  SELECT *, list_sum([v[i] * list_sum([h[i][j] * v[j] FOR j IN range(1, {count + 3})]) FOR i IN range(1, {count + 3})]) AS e,
    h[{count + 2}][{count + 2}] - h[1][{count + 2}] * h[1][{count + 2}] / h[1][1] AS whole FROM sides
)"""


_recursive("linear_folds", f"""{_EQUATIONS},{_errors(_COUNT)}
SELECT segment, modele, tenu AS pli, CAST(g[1][1] AS BIGINT) AS appris, CAST(h[1][1] AS BIGINT) AS tenus, {_significant('sqrt(e / h[1][1])', 8)} AS rmse,
  {even('1 - e / whole', 6)} AS r2 FROM errors""")

_FOLD_STATS = """
  SELECT r.segment, departement, held, avg(valeur_fonciere) AS dept_mean_price, quantile_cont(valeur_fonciere, 0.5) AS dept_median_price,
    stddev_samp(valeur_fonciere) AS dept_std_price, count(*) AS dept_count_trans, avg(surface_reelle_bati) AS dept_mean_surface
  FROM roomy_all r, range(5) t(held) WHERE lot = 'train' AND pli <> held GROUP BY 1, 2, 3"""
sql("fold_dept_stats", f"""{ALL_FEATURES}
SELECT segment, departement, CAST(held AS INTEGER) AS held, dept_count_trans, {', '.join(f"{even(c, 2)} AS {c}" for c in [
    'dept_mean_price', 'dept_median_price', 'dept_std_price', 'dept_mean_surface'])} FROM ({_FOLD_STATS})""")
_FOLDED = _equations(len(FOLD_MEASURES), f"""
  SELECT f.segment * 100 + held AS segment, CAST(pli = held AS INTEGER) AS pli, {_vector([*FOLD_MEASURES, 'valeur_fonciere'])} AS v
  FROM frame_all f JOIN ({_FOLD_STATS}) d ON f.segment = d.segment AND f.departement = d.departement
  WHERE lot = 'train' AND dept_std_price IS NOT NULL""")
_recursive("fold_cross_validation", f"""{_FOLDED},{_errors(len(FOLD_MEASURES))}
SELECT CAST(segment // 100 AS INTEGER) AS segment, CAST(segment % 100 AS INTEGER) AS pli, CAST(g[1][1] AS BIGINT) AS appris, CAST(h[1][1] AS BIGINT) AS tenus,
  {_significant('sqrt(e / h[1][1])', 8)} AS rmse, {even('1 - e / whole', 6)} AS r2 FROM errors WHERE tenu = 1 AND modele = 'Linear Regression'""")

_BINS, _LEAST, _PENALTY, _TIE = Settings.bins, Settings.least_rows, Settings.penalty, TIE
sql("boosting_splits", f"""{ALL_FEATURES},
learn AS (SELECT segment, valeur_fonciere AS y, [{', '.join(f"CAST({c} AS DOUBLE)" for c in MEASURES)}] AS v FROM frame_all WHERE lot = 'train'),
long AS (SELECT segment, y, unnest(v) AS x, unnest(range(1, {len(MEASURES) + 1})) AS f FROM learn),
edges AS (SELECT DISTINCT f, unnest(quantile_cont(x, [{', '.join(str(i / _BINS) for i in range(1, _BINS))}])) AS e FROM long GROUP BY f),
starts AS (SELECT segment, avg(y) AS y0 FROM learn GROUP BY 1),
values AS (SELECT l.segment, f, x, sum(y0 - y) AS g, count(*) AS n FROM long l JOIN starts s ON l.segment = s.segment GROUP BY 1, 2, 3),
halves AS (
  SELECT v.segment, v.f, e, sum(g) FILTER (x <= e) AS gl, sum(n) FILTER (x <= e) AS nl, sum(g) FILTER (x > e) AS gr, sum(n) FILTER (x > e) AS nr
  FROM values v JOIN edges ON v.f = edges.f GROUP BY 1, 2, 3
),
gains AS (
  SELECT *, (gl * gl / (nl + {_PENALTY}::DOUBLE) + gr * gr / (nr + {_PENALTY}::DOUBLE) - (gl + gr) * (gl + gr) / (nl + nr + {_PENALTY}::DOUBLE)) / 2 AS gain
  FROM halves WHERE nl >= {_LEAST} AND nr >= {_LEAST}
),
first AS (
  SELECT * FROM (SELECT *, max(gain) OVER (PARTITION BY segment) AS top FROM gains) WHERE gain >= top - {_TIE}::DOUBLE * top
  QUALIFY row_number() OVER (PARTITION BY segment ORDER BY f, e) = 1
)
SELECT segment, ([{', '.join(f"'{c}'" for c in MEASURES)}])[f] AS variable, {_significant('e', 8)} AS borne, {_significant('gain', 8)} AS gain FROM first""")

_P = "valeur_fonciere_predite"
_MEANS = f"SELECT departement, {even(f'avg({_P})', 2)} AS prix_moyen FROM predicted GROUP BY 1"
sql("predictions_by_department", _MEANS)
sql("predictions_by_month", f"""
SELECT mois, departement, {even(f'avg({_P})', 2)} AS prix_moyen FROM predicted WHERE departement = '04' GROUP BY 1, 2""")
sql("predictions_extremes", f"""
SELECT * FROM (SELECT *, 'plus chers' AS liste FROM ({_MEANS}) ORDER BY prix_moyen DESC, departement LIMIT 5)
UNION ALL SELECT * FROM (SELECT *, 'moins chers' AS liste FROM ({_MEANS}) ORDER BY prix_moyen, departement LIMIT 5)""")
sql("predictions_summary", f"""
SELECT {even(f'quantile_cont({_P}, 0.5)', 2)} AS mediane, {even(f'avg({_P})', 2)} AS moyenne FROM predicted""")
_TOP10 = """(SELECT * FROM predicted WHERE departement IN (
  SELECT departement FROM predicted GROUP BY 1 ORDER BY count(*) DESC, departement LIMIT 10))"""
sql("predictions_box_top10", f"""
SELECT departement, n, {', '.join(f"{even(c, 2)} AS {c}" for c in ['q1', 'mediane', 'q3', 'moustache_basse', 'moustache_haute'])}, hors
FROM ({_box(_TOP10, 'departement', _P)})""")


def _source(name: str, price: str) -> str:
    return f"""SELECT '{name}' AS source, count(*) AS nombre, {even(f'avg({price})', 2)} AS prix_moyen,
  {even(f'quantile_cont({price}, 0.5)', 2)} AS prix_median, {even(f'stddev_samp({price})', 2)} AS ecart_type,
  {even('avg(surface_reelle_bati)', 2)} AS surface_moyenne FROM predicted"""


sql("predicted_against_observed", f"{_source('reel', 'valeur_fonciere')} UNION ALL {_source('predit', _P)}")
sql("predicted_by_department", f"""
SELECT departement, count(*) AS nb_reel, {even('avg(valeur_fonciere)', 2)} AS prix_reel, count(*) AS nb_predit,
       {even(f'avg({_P})', 2)} AS prix_predit
FROM predicted GROUP BY 1 ORDER BY nb_reel DESC, departement LIMIT 10""")
_BOTH = f"""(SELECT 'reel' AS source, valeur_fonciere AS prix FROM predicted
 UNION ALL SELECT 'predit', {_P} FROM predicted)"""
sql("predicted_histogram", _histogram(_BOTH, "source", "prix", 50, 4))


def _line(name: str, price: str) -> str:
    return f"""SELECT '{name}' AS source, {even('p', 3)} AS pente, {even('o', 3)} AS ordonnee, x_min, x_max,
  {even('p * x_min + o', 3)} AS y_min, {even('p * x_max + o', 3)} AS y_max, {even('m', 3)} AS prix_m2_moyen
FROM (SELECT regr_slope({price}, surface_reelle_bati) AS p, regr_intercept({price}, surface_reelle_bati) AS o,
             min(surface_reelle_bati) AS x_min, max(surface_reelle_bati) AS x_max,
             avg({price} / surface_reelle_bati) AS m FROM predicted)"""


sql("predicted_line", f"{_line('reel', 'valeur_fonciere')} UNION ALL {_line('predit', _P)}")
sql("department_list", f"SELECT DISTINCT substr({pad5('code_postal')}, 1, 2) AS departement FROM silver")

# --- streaming --------------------------------------------------------------------------

sql("stream_bronze", "SELECT * FROM bronze")
sql("stream_audit", "SELECT 'ok' AS status, count(*) AS lignes FROM bronze")
sql("stream_without_replays", """
SELECT commune, count(*) AS lignes, sum(valeur_fonciere) AS total
FROM (SELECT DISTINCT date_mutation, code_postal, valeur_fonciere, commune, type_local FROM bronze) GROUP BY 1""")
sql("stream_overview", f"""
SELECT commune, nb, (SELECT CAST(count(*) AS BIGINT) FROM bronze) AS total,
       (SELECT {even('avg(valeur_fonciere)', 2)} FROM bronze) AS moyenne FROM ({_TOP5})""")
sql("stream_kpis", f"""
SELECT commune, count(*) AS nb, {even('avg(valeur_fonciere)', 2)} AS moyenne FROM bronze GROUP BY 1""")
sql("stream_events", f"""
SELECT event_type, count(*) AS nb, {even('avg(value)', 4)} AS moyenne FROM events GROUP BY 1""")
