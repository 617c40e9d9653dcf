"""Independent SQL (DuckDB dialect) for every registered query, over the driver tables
registered as views. Written from the domain rules, not generated from the Spark plans.

Rounding: Spark's ``round`` on a double is half-up on the shortest decimal text of the
value; ``RHU`` reproduces that in DuckDB (whose ``round`` works on the binary value)."""

from __future__ import annotations


def RHU(x: str, d: int = 2) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {d}) AS DOUBLE)"


VALUE_TEXT = ("CASE WHEN k % 17 = 0 THEN '' WHEN k % 13 = 0 THEN CAST(0.0 - value AS VARCHAR) "
              "ELSE coalesce(CAST(value AS VARCHAR), '') END")

# Words that are no commune, and first words of compound communes.
NOISE = ("'periurbaine','periurb','urbain','urbaine','rurale','trafic','stade','mairie','zi','za','rocade',"
         "'sud','nord','est','ouest','boulevards','centre','peripherique','autoroute','zone','parc'")
PREFIXES = "'st','saint','sainte','ste','le','la','les','aix'"

TITLE = ("array_to_string(list_transform(range(1, length(z) + 1), lambda i: CASE WHEN i = 1 OR NOT "
         "regexp_matches(substr(z, i - 1, 1), '^\\p{L}$') THEN upper(substr(z, i, 1)) "
         "ELSE lower(substr(z, i, 1)) END), '')")

BASE = f"""
ev AS (
  SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, date_trunc('hour', ts) AS hr
  FROM events
),
labelled AS (
  SELECT *, CASE WHEN k % 19 = 1 THEN 'SO2' WHEN k % 19 = 2 THEN 'CO' WHEN event_type = 'view' THEN 'O3' WHEN event_type = 'purchase' THEN 'PM10'
                 WHEN event_type = 'signup' THEN 'PM2.5' WHEN event_type = 'click' THEN 'NO2' WHEN event_type = 'error' THEN 'C6H6' END AS label,
         CASE WHEN k % 37 = 0 THEN '' WHEN k % 41 = 0 THEN '2024/99/99 00:00:00' ELSE coalesce(strftime(hr, '%Y/%m/%d %H:%M:%S'), '') END AS debut
  FROM ev
),
bronze AS (
  SELECT
    debut AS date_debut,
    coalesce(strftime(hr + INTERVAL 1 HOUR, '%Y/%m/%d %H:%M:%S'), '') AS date_fin,
    'AASQA ' || CAST(user_id % 13 AS VARCHAR) AS organisme,
    'FRZAG' || lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS code_zas,
    rtrim((['ZAG ', 'ZAR ', 'ZA '])[user_id % 3 + 1] || 'NATION ' || CAST(user_id % 25 AS VARCHAR)) AS zas,
    CAST(user_id AS VARCHAR) AS code_site,
    trim(CASE user_id % 8 WHEN 3 THEN 'Saint Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0') || ' Centre'
      WHEN 4 THEN 'A7 Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0') WHEN 5 THEN 'Rocade_Sud-' || user_id
      WHEN 6 THEN '' ELSE 'Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END || CASE WHEN k % 31 = 0 THEN ' Bis' ELSE '' END) AS nom_site,
    (['Urbaine', 'Periurbaine', 'Rurale'])[user_id % 3 + 1] AS type_implantation,
    label AS polluant_source,
    replace(label, '.', '') AS code_polluant,
    (['Fond', 'Trafic', 'Industrielle', ''])[user_id % 4 + 1] AS type_influence,
    'moyenne horaire brute' AS type_valeur,
    {VALUE_TEXT} AS valeur,
    {VALUE_TEXT} AS valeur_brute,
    CASE WHEN k % 29 = 0 THEN 'parties par milliard (ppb)' WHEN k % 19 = 2 THEN 'mg-m3' WHEN k % 7 = 0 THEN 'µg/m3' ELSE 'µg-m3' END AS unite_source,
    CASE WHEN k % 29 = 0 THEN 'parties par milliard (ppb)' WHEN k % 19 = 2 THEN 'mg/m3' ELSE 'ug/m3' END AS unite,
    'A' AS code_qualite,
    CASE WHEN k % 10 = 0 THEN '-1' WHEN k % 23 = 0 THEN '' ELSE '1' END AS validite,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS _ingested_at,
    CASE WHEN length(debut) < 10 THEN 'inconnue' ELSE replace(substr(debut, 1, 10), '/', '-') END AS date
  FROM labelled
  WHERE label IN ('NO2', 'O3', 'PM10', 'PM2.5', 'SO2', 'CO')
),
typed AS (
  SELECT *, CASE WHEN isnan(v0) OR isinf(v0) THEN NULL ELSE v0 END AS valeur_num,
         try_strptime(date_debut, '%Y/%m/%d %H:%M:%S') AS horodatage,
         try_strptime(date_fin, '%Y/%m/%d %H:%M:%S') AS horodatage_fin
  FROM (SELECT *, TRY_CAST(valeur AS DOUBLE) AS v0 FROM bronze)
),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY code_site, code_polluant, horodatage
                                 ORDER BY _ingested_at ASC NULLS LAST, valeur_num ASC NULLS LAST,
                                          validite ASC NULLS LAST, nom_site, unite, organisme, code_zas, zas,
                                          type_implantation, type_influence, type_valeur, horodatage_fin) AS rn
    FROM typed WHERE validite <> '-1') WHERE rn = 1
),
silver AS (
  SELECT d.code_site, d.nom_site, d.organisme, d.code_zas, d.zas, d.type_implantation, d.type_influence,
         d.code_polluant, d.horodatage, d.horodatage_fin, CAST(d.horodatage AS DATE) AS date_mesure,
         d.valeur_num AS valeur, d.unite, d.type_valeur, d.validite,
         CASE WHEN t.alerte IS NOT NULL AND d.valeur_num >= t.alerte THEN 'alerte'
              WHEN t.info IS NOT NULL AND d.valeur_num >= t.info THEN 'info' END AS depassement,
         d._ingested_at
  FROM dedup d
  LEFT JOIN (VALUES ('NO2', 200.0, 400.0), ('O3', 180.0, 240.0), ('PM10', 50.0, 80.0),
                    ('PM25', NULL, NULL), ('SO2', 300.0, 500.0), ('CO', NULL, NULL)) AS t(code, info, alerte)
    ON d.code_polluant = t.code
),
means AS (
  SELECT code_site, nom_site, code_polluant, date_mesure, unite,
         {RHU('CAST(sum(CAST(va AS DECIMAL(28, 10))) AS DOUBLE) / nullif(count(va), 0)')} AS moyenne, {RHU('min(va)')} AS minimum, {RHU('max(va)')} AS maximum,
         count(*) AS nb_mesures
  FROM (SELECT *, CASE WHEN valeur < 0 THEN 0.0 ELSE valeur END AS va FROM silver)
  GROUP BY code_site, nom_site, code_polluant, date_mesure, unite
),
subidx AS (
  SELECT *, CASE code_polluant
    WHEN 'NO2' THEN CASE WHEN moyenne <= 40 THEN 1 WHEN moyenne <= 90 THEN 2 WHEN moyenne <= 120 THEN 3
                         WHEN moyenne <= 230 THEN 4 WHEN moyenne <= 340 THEN 5 WHEN moyenne IS NOT NULL THEN 6 END
    WHEN 'O3' THEN CASE WHEN moyenne <= 50 THEN 1 WHEN moyenne <= 100 THEN 2 WHEN moyenne <= 130 THEN 3
                        WHEN moyenne <= 240 THEN 4 WHEN moyenne <= 380 THEN 5 WHEN moyenne IS NOT NULL THEN 6 END
    WHEN 'PM10' THEN CASE WHEN moyenne <= 20 THEN 1 WHEN moyenne <= 40 THEN 2 WHEN moyenne <= 50 THEN 3
                          WHEN moyenne <= 100 THEN 4 WHEN moyenne <= 150 THEN 5 WHEN moyenne IS NOT NULL THEN 6 END
    WHEN 'PM25' THEN CASE WHEN moyenne <= 10 THEN 1 WHEN moyenne <= 20 THEN 2 WHEN moyenne <= 25 THEN 3
                          WHEN moyenne <= 50 THEN 4 WHEN moyenne <= 75 THEN 5 WHEN moyenne IS NOT NULL THEN 6 END
    WHEN 'SO2' THEN CASE WHEN moyenne <= 100 THEN 1 WHEN moyenne <= 200 THEN 2 WHEN moyenne <= 350 THEN 3
                         WHEN moyenne <= 500 THEN 4 WHEN moyenne <= 750 THEN 5 WHEN moyenne IS NOT NULL THEN 6 END
    WHEN 'CO' THEN CASE WHEN moyenne <= 4 THEN 1 WHEN moyenne <= 8 THEN 2 WHEN moyenne <= 10 THEN 3
                        WHEN moyenne <= 15 THEN 4 WHEN moyenne <= 30 THEN 5 WHEN moyenne IS NOT NULL THEN 6 END
  END AS si
  FROM means
),
indice AS (
  SELECT code_site, nom_site, date_mesure, indice_atmo, polluant_resp,
         CASE indice_atmo WHEN 1 THEN 'Bon' WHEN 2 THEN 'Moyen' WHEN 3 THEN 'Degrade' WHEN 4 THEN 'Mauvais'
                          WHEN 5 THEN 'Tres mauvais' WHEN 6 THEN 'Extremement mauvais' END AS qualificatif
  FROM (
    SELECT code_site, nom_site, date_mesure, max(si) AS indice_atmo,
           (list(code_polluant ORDER BY si DESC, code_polluant ASC) FILTER (WHERE si IS NOT NULL))[1] AS polluant_resp
    FROM subidx GROUP BY code_site, nom_site, date_mesure)
),
depassements AS (
  SELECT code_site, nom_site, code_polluant, horodatage, date_mesure, valeur, unite, depassement
  FROM silver WHERE depassement IS NOT NULL
),
st_distinct AS (
  SELECT code_site, nom_site, organisme, code_zas, zas, type_implantation, type_influence FROM (
    SELECT *, row_number() OVER (PARTITION BY code_site ORDER BY nom_site, organisme, code_zas, zas,
                                 type_implantation, type_influence) AS rn
    FROM typed WHERE validite <> '-1') WHERE rn = 1
),
st_tok AS (
  SELECT *, list_filter(string_split_regex(translate(coalesce(nom_site, ''), '_-', '  '), '\\s+'), lambda x: x <> '') AS toks,
         regexp_replace(replace(replace(replace(coalesce(zas, ''), 'ZAG', ''), 'ZAR', ''), 'ZA ', ''),
                        '^\\s+|\\s+$', '', 'g') AS z
  FROM st_distinct
),
st_commune AS (
  SELECT * EXCLUDE (toks, z, zone_name, rest, stop),
    CASE WHEN len(toks) = 0 THEN zone_name
         WHEN regexp_full_match(toks[1], '(?i)(a\\d+|n\\d+|d\\d+|rd\\d+|zi|za)') OR lower(toks[1]) IN ({NOISE})
           THEN zone_name
         WHEN lower(toks[1]) IN ({PREFIXES}) AND len(toks) > 1
           THEN array_to_string(list_concat([toks[1]],
                  rest[1:CASE WHEN coalesce(stop, 0) = 0 THEN len(rest) ELSE stop - 1 END]), ' ')
         ELSE toks[1] END AS commune_extraite
  FROM (
    SELECT *, {TITLE} AS zone_name, toks[2:] AS rest,
           list_position(list_transform(toks[2:], lambda x: lower(x) IN ({NOISE})), true) AS stop
    FROM st_tok)
),
gazetteer AS (
  SELECT unnest([s_name, 'Saint ' || s_name, 'Nation ' || CAST(s_nationkey AS VARCHAR)]) AS commune, s_name AS label,
         'region ' || CAST(s_nationkey AS VARCHAR) AS contexte,
         CASE WHEN s_acctbal >= 0 THEN -4.5 + CAST(s_nationkey % 25 AS DOUBLE) * 0.5 END AS longitude,
         CASE WHEN s_acctbal >= 0 THEN 41.0 + CAST(s_suppkey % 64 AS DOUBLE) * 0.125 END AS latitude
  FROM supplier
),
gaz1 AS (
  SELECT key, label AS commune_label, contexte, longitude, latitude FROM (
    SELECT *, lower(commune) AS key,
           row_number() OVER (PARTITION BY lower(commune) ORDER BY label, contexte, longitude NULLS FIRST, latitude NULLS FIRST) AS rn
    FROM gazetteer) WHERE rn = 1
),
st_geo AS (
  SELECT c.*, g.commune_label, g.contexte, g.longitude, g.latitude,
         (g.latitude IS NOT NULL AND g.longitude IS NOT NULL) AS geocode_ok
  FROM st_commune c LEFT JOIN gaz1 g ON lower(c.commune_extraite) = g.key
),
stations AS (
  SELECT code_site AS code_station, nom_site AS nom, CAST(NULL AS VARCHAR) AS code_region,
         type_implantation AS type_station, type_influence, latitude, longitude
  FROM st_geo
),
station_base AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS code_station, s_name AS nom,
         CASE WHEN s_suppkey % 17 = 0 THEN '99' ELSE CAST(s_nationkey AS VARCHAR) END AS code_region,
         (['Urbaine', 'Periurbaine', 'Rurale'])[s_suppkey % 3 + 1] AS type_station,
         (['Fond', 'Trafic', 'Industrielle', ''])[s_suppkey % 4 + 1] AS type_influence,
         CASE WHEN s_acctbal >= 0 THEN 41.0 + CAST(s_suppkey % 64 AS DOUBLE) * 0.125 END AS latitude,
         CASE WHEN s_acctbal >= 0 THEN -4.5 + CAST(s_nationkey % 25 AS DOUBLE) * 0.5 END AS longitude
  FROM supplier
),
station_merged AS (
  SELECT coalesce(b.code_station, u.code_station) AS code_station,
         CASE WHEN u.code_station IS NOT NULL THEN u.nom ELSE b.nom END AS nom,
         b.code_region,
         CASE WHEN u.code_station IS NOT NULL THEN u.type_station ELSE b.type_station END AS type_station,
         CASE WHEN u.code_station IS NOT NULL THEN u.type_influence ELSE b.type_influence END AS type_influence,
         CASE WHEN u.code_station IS NOT NULL THEN u.latitude ELSE b.latitude END AS latitude,
         CASE WHEN u.code_station IS NOT NULL THEN u.longitude ELSE b.longitude END AS longitude
  FROM station_base b FULL OUTER JOIN stations u ON b.code_station = u.code_station
),
regions AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS code_region, n_name AS nom FROM nation
),
pollutant_seed AS (
  SELECT * FROM (VALUES ('NO2', 'Dioxyde d''azote', 'ug/m3', 200.0, 400.0),
                        ('O3', 'Ozone', 'ug/m3', 180.0, 240.0),
                        ('PM10', 'Particules < 10um', 'ug/m3', 50.0, 80.0),
                        ('PM25', 'Particules fines < 2.5um', 'ug/m3', NULL, NULL),
                        ('SO2', 'Dioxyde de soufre', 'ug/m3', 300.0, 500.0),
                        ('CO', 'Monoxyde de carbone', 'mg/m3', NULL, NULL))
         AS t(code_polluant, libelle, unite, seuil_info, seuil_alerte)
),
idx_serv AS (
  SELECT i.code_site, i.nom_site, i.date_mesure AS jour, i.indice_atmo, i.qualificatif, i.polluant_resp,
         s.latitude, s.longitude
  FROM indice i LEFT JOIN stations s ON i.code_site = s.code_station
),
means_serv AS (
  SELECT code_site, nom_site, code_polluant, date_mesure AS jour, moyenne, minimum, maximum, nb_mesures, unite
  FROM means
),
exc_serv AS (
  SELECT code_site, nom_site, code_polluant, horodatage, date_mesure AS jour, valeur, unite, depassement
  FROM depassements
),
idx_norm AS (
  SELECT nullif(code_site, '') AS code_station, coalesce(nullif(nom_site, ''), 'Station') AS nom,
         CAST(indice_atmo AS INTEGER) AS indice, nullif(qualificatif, '') AS qualificatif,
         nullif(polluant_resp, '') AS polluant, latitude, longitude, jour
  FROM idx_serv
),
ds AS (
  SELECT n.*, coalesce(nullif(s.type_station, ''), '—') AS type_station,
         coalesce(nullif(s.type_influence, ''), '—') AS type_influence
  FROM idx_norm n LEFT JOIN stations s ON n.code_station = s.code_station
  WHERE n.latitude IS NOT NULL AND n.longitude IS NOT NULL AND n.jour = (SELECT max(jour) FROM idx_serv)
),
means_list_order AS (
  SELECT * FROM means_serv
),
exc_list AS (
  SELECT * FROM exc_serv
  ORDER BY horodatage DESC NULLS FIRST, code_site ASC NULLS LAST, code_polluant ASC NULLS LAST, valeur DESC NULLS FIRST
  LIMIT 1000
),
questions AS (
  SELECT conv_id, turn,
         (['Combien de stations ? ', 'Où sont les alertes ? ', 'La station la plus polluée ? ', 'La meilleure ? ', 'Quel polluant ? ',
           'Qualité de l''air ? ', 'Bonjour ! ', 'Help! ', '', '', 'A Supplier#' || lpad(CAST((conv_id * 3 + turn) % 120 AS VARCHAR), 9, '0') || ' ? ',
           'a supplier#' || lpad(CAST((conv_id * 3 + turn) % 120 AS VARCHAR), 9, '0') || ' ? '])[(conv_id + turn) % 12 + 1] || coalesce(text, '') AS question
  FROM conversations
),
city_cand AS (
  SELECT code_station, nom, mot, indice FROM (
    SELECT code_station, nom, indice, string_split(lower(nom), ' ')[1] AS mot FROM ds
    WHERE nom IS NOT NULL AND nom <> '') WHERE length(mot) >= 4
),
city AS (
  SELECT conv_id, turn, code_station, nom, mot FROM (
    SELECT q.conv_id, q.turn, c.code_station, c.nom, c.mot,
           row_number() OVER (PARTITION BY q.conv_id, q.turn
                              ORDER BY (c.indice IS NOT NULL), -c.indice, c.code_station) AS rn
    FROM questions q JOIN city_cand c ON contains(lower(coalesce(q.question, '')), c.mot)) WHERE rn = 1
)
"""
# Stations with misspelt names, their communes, and the best gazetteer entry for each folded name.
FOLD = "regexp_replace(regexp_replace(trim(regexp_replace(strip_accents(lower({0})), '[^a-z0-9]+', ' ', 'g')), '(^| )st( |$)', '\\1saint\\2', 'g'), '(^| )ste( |$)', '\\1sainte\\2', 'g')"
MISSPELT = f""",
wrong AS (
  SELECT * REPLACE (CASE kind WHEN 1 THEN replace(nom_site, 'Supplier', 'Suplier')
      WHEN 3 THEN replace(replace(nom_site, 'Saint', 'St'), 'Supplier', 'Süppliér') WHEN 4 THEN replace(nom_site, 'Supplier', 'Sapplyer')
      WHEN 5 THEN split_part(nom_site, '#', 1) ELSE nom_site END AS nom_site)
  FROM (SELECT *, CAST(code_site AS BIGINT) % 6 AS kind FROM st_distinct)
),
wrong_tok AS (
  SELECT *, list_filter(string_split_regex(translate(coalesce(nom_site, ''), '_-', '  '), '\\s+'), lambda x: x <> '') AS toks,
         regexp_replace(replace(replace(replace(coalesce(zas, ''), 'ZAG', ''), 'ZAR', ''), 'ZA ', ''), '^\\s+|\\s+$', '', 'g') AS z
  FROM wrong
),
misspelt AS (
  SELECT *, {FOLD.format('commune_extraite')} AS name FROM (
    SELECT * EXCLUDE (toks, z, zone_name, rest, stop),
      CASE WHEN len(toks) = 0 THEN zone_name
           WHEN regexp_full_match(toks[1], '(?i)(a\\d+|n\\d+|d\\d+|rd\\d+|zi|za)') OR lower(toks[1]) IN ({NOISE}) THEN zone_name
           WHEN lower(toks[1]) IN ({PREFIXES}) AND len(toks) > 1
             THEN array_to_string(list_concat([toks[1]], rest[1:CASE WHEN coalesce(stop, 0) = 0 THEN len(rest) ELSE stop - 1 END]), ' ')
           ELSE toks[1] END AS commune_extraite
    FROM (SELECT *, {TITLE} AS zone_name, toks[2:] AS rest, list_position(list_transform(toks[2:], lambda x: lower(x) IN ({NOISE})), true) AS stop
          FROM wrong_tok))
),
entry AS (
  SELECT {FOLD.format('commune')} AS entry, label AS commune_label, contexte, longitude, latitude FROM gazetteer
  QUALIFY row_number() OVER (PARTITION BY {FOLD.format('commune')} ORDER BY label, contexte, longitude NULLS FIRST, latitude NULLS FIRST) = 1
),
best_place AS (
  SELECT name, commune_label, contexte, longitude, latitude, CASE WHEN r < 3 THEN r END AS edits,
         CASE r WHEN 0 THEN 'exact' WHEN 3 THEN 'premiers mots' ELSE 'orthographe' END AS par
  FROM (SELECT name, e.*, CASE WHEN levenshtein(name, entry) <= (CASE WHEN length(name) < 4 THEN 0 WHEN length(name) < 9 THEN 1 ELSE 2 END) THEN levenshtein(name, entry)::INTEGER
                               WHEN length(name) >= 3 AND starts_with(entry, name || ' ') THEN 3 END AS r
        FROM (SELECT DISTINCT name FROM misspelt WHERE name <> '') CROSS JOIN entry e)
  WHERE r IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY r, commune_label, contexte, longitude NULLS FIRST, latitude NULLS FIRST) = 1
)
"""

# Labels by language.
LABELS = """, labels(langue, labels) AS (VALUES
    ('fr', ['Bon', 'Moyen', 'Dégradé', 'Mauvais', 'Très mauvais', 'Extrêmement mauvais', 'Non mesuré']),
    ('en', ['Good', 'Fair', 'Degraded', 'Poor', 'Very poor', 'Extremely poor', 'Not measured']),
    ('es', ['Buena', 'Media', 'Degradada', 'Mala', 'Muy mala', 'Extremadamente mala', 'No medida']),
    ('de', ['Gut', 'Mäßig', 'Verschlechtert', 'Schlecht', 'Sehr schlecht', 'Extrem schlecht', 'Nicht gemessen']),
    ('ja', ['良好', '普通', 'やや悪い', '悪い', '非常に悪い', '極めて悪い', '未測定']),
    ('zh', ['优', '良', '轻度污染', '中度污染', '重度污染', '严重污染', '未测量']),
    ('pt', ['Boa', 'Média', 'Degradada', 'Má', 'Muito má', 'Extremamente má', 'Não medida']),
    ('yo', ['Dáradára', 'Àárín', 'Dínkù', 'Búburú', 'Búburú gan', 'Búburú púpọ̀', 'Kò wọ̀n'])
)"""

MEANS_ORDER = ("jour DESC NULLS FIRST, moyenne DESC NULLS FIRST, code_site ASC NULLS LAST, "
               "code_polluant ASC NULLS LAST, nom_site ASC NULLS LAST, unite ASC NULLS LAST")


# The keyword rules of the question router, in rule order.
INTENT = """CASE
  WHEN (contains(q, 'combien') OR contains(q, 'how many') OR contains(q, 'cuánt') OR contains(q, 'wie viele') OR contains(q, 'quant') OR contains(q, 'mélòó') OR contains(q, '多少') OR contains(q, '何'))
    AND (contains(q, 'station') OR contains(q, 'esta') OR contains(q, '地点') OR contains(q, '站') OR contains(q, 'ibùdó')) THEN 'count'
  WHEN contains(q, 'alerte') OR contains(q, 'alert') OR contains(q, '警報') OR contains(q, '警报') OR contains(q, 'alarm') OR contains(q, 'ìkìlọ̀') OR contains(q, 'excede') OR contains(q, 'dépass') OR contains(q, '超過') OR contains(q, '超标') OR contains(q, 'überschr') THEN 'alerts'
  WHEN contains(q, 'plus pollu') OR contains(q, 'most pollut') OR contains(q, '汚染') OR contains(q, '污染') OR contains(q, 'contamin') OR contains(q, 'bàjẹ́') OR contains(q, 'schlecht') OR contains(q, 'belast') OR contains(q, 'pire') OR contains(q, 'worst') THEN 'worst'
  WHEN has_index AND (contains(q, 'meilleur') OR contains(q, 'best') OR contains(q, 'moins pollu') OR contains(q, 'cleanest') OR contains(q, '最も良い') OR contains(q, '最好') OR contains(q, 'mejor') OR contains(q, 'beste') OR contains(q, 'melhor')) THEN 'best'
  WHEN has_index AND (contains(q, 'polluant') OR contains(q, 'pollutant') OR contains(q, '汚染物質') OR contains(q, '污染物') OR contains(q, 'contaminante') OR contains(q, 'schadstoff') OR contains(q, 'poluente')) THEN 'pollutant'
  WHEN contains(q, 'qualité') OR contains(q, 'quality') OR contains(q, '質') OR contains(q, '质量') OR contains(q, 'calidad') OR contains(q, 'qualidade') OR contains(q, 'ìmọ́tótó') OR contains(q, 'luftqual') OR contains(q, 'aujourd') OR contains(q, 'today') OR contains(q, 'hoy') OR contains(q, 'heute') OR contains(q, 'lónìí') OR contains(q, '今日') OR contains(q, '今天') OR contains(q, 'état') OR contains(q, 'situation') THEN 'quality'
  WHEN contains(q, 'bonjour') OR contains(q, 'salut') OR contains(q, 'hello') OR contains(q, 'hi ') OR contains(q, 'hola') OR contains(q, 'こんにち') OR contains(q, '你好') OR contains(q, 'olá') OR contains(q, 'ẹ nlẹ') OR contains(q, 'hallo') OR contains(q, 'merci') OR contains(q, 'thanks') OR contains(q, 'gracias') THEN 'greeting'
  WHEN contains(q, 'aide') OR contains(q, 'help') OR contains(q, 'que peux') OR contains(q, 'what can') OR contains(q, 'ayuda') OR contains(q, 'hilfe') OR contains(q, '何ができ') OR contains(q, '能做什么') OR contains(q, 'ajuda') THEN 'help' END"""


SELECTS: dict[str, str] = {
    "daily_index": "SELECT * FROM indice",
    "daily_means": "SELECT * FROM means",
    "bronze_records": "SELECT * FROM bronze",
    "silver_measurements": "SELECT * FROM silver",
    "silver_one_day": "SELECT * FROM silver WHERE starts_with(strftime(horodatage, '%Y/%m/%d'), '2024/01/15')",
    "exceedance_distribution": "SELECT depassement, count(*) AS nb FROM silver GROUP BY depassement",
    "silver_run_metrics": """
        SELECT count(*) AS rows_read, count(*) AS rows_in_scope,
               count(*) FILTER (WHERE validite = '-1') AS rows_invalid,
               count(*) FILTER (WHERE validite <> '-1') AS rows_valid,
               (SELECT count(*) FROM dedup) AS rows_written,
               count(*) FILTER (WHERE validite <> '-1') - (SELECT count(*) FROM dedup) AS duplicates_removed
        FROM typed""",
    "exceedance_mart": "SELECT * FROM depassements",
    "merged_silver": "SELECT * FROM silver",
    "merged_means": "SELECT * FROM means",
    "station_sub_indices": """
        SELECT code_site, date_mesure,
               max(si) FILTER (WHERE code_polluant = 'NO2') AS sous_indice_no2,
               max(si) FILTER (WHERE code_polluant = 'O3') AS sous_indice_o3,
               max(si) FILTER (WHERE code_polluant = 'PM10') AS sous_indice_pm10,
               max(si) FILTER (WHERE code_polluant = 'PM25') AS sous_indice_pm25,
               max(si) FILTER (WHERE code_polluant = 'SO2') AS sous_indice_so2,
               max(si) FILTER (WHERE code_polluant = 'CO') AS sous_indice_co
        FROM subidx GROUP BY code_site, date_mesure""",
    "index_distribution": "SELECT indice_atmo, qualificatif, count(*) AS nb FROM indice GROUP BY ALL",
    "sample_means": """
        SELECT code_site, code_polluant, moyenne, minimum, maximum, nb_mesures FROM means
        ORDER BY code_site ASC NULLS FIRST, code_polluant ASC NULLS FIRST, date_mesure ASC NULLS FIRST,
                 nom_site ASC NULLS FIRST, unite ASC NULLS FIRST LIMIT 10""",
    "serving_index": "SELECT * FROM idx_serv",
    "list_stations": """
        SELECT code_station, nom, type_station, type_influence, latitude, longitude FROM stations
        WHERE latitude IS NOT NULL ORDER BY nom, code_station""",
    "list_indices_all_days": """
        SELECT * FROM idx_serv WHERE latitude IS NOT NULL
        ORDER BY jour DESC NULLS FIRST, indice_atmo DESC NULLS FIRST, code_site""",
    "list_indices_latest_day": """
        SELECT * FROM idx_serv WHERE latitude IS NOT NULL AND jour = (SELECT max(jour) FROM idx_serv)
        ORDER BY indice_atmo DESC NULLS FIRST, code_site""",
    "list_indices_day": """
        SELECT * FROM idx_serv WHERE latitude IS NOT NULL AND jour = DATE '2024-01-15'
        ORDER BY indice_atmo DESC NULLS FIRST, code_site""",
    "list_means_day": f"""
        SELECT * FROM means_serv WHERE code_polluant = 'NO2' AND jour = DATE '2024-01-15' ORDER BY {MEANS_ORDER} LIMIT 2000""",
    "list_exceedances_day": "SELECT * FROM exc_serv WHERE jour = DATE '2024-01-15' ORDER BY horodatage DESC, code_site, code_polluant",
    "list_means_pollutant": f"SELECT * FROM means_serv WHERE code_polluant = 'NO2' ORDER BY {MEANS_ORDER} LIMIT 2000",
    "list_means_all": f"SELECT * FROM means_serv ORDER BY {MEANS_ORDER} LIMIT 2000",
    "list_exceedances": "SELECT * FROM exc_list",
    "list_exceedances_latest_day": """
        SELECT * FROM exc_serv WHERE jour = (SELECT max(jour) FROM idx_serv)""",
    "global_stats": """
        SELECT (SELECT count(*) FROM stations) AS nb_stations,
               (SELECT count(*) FROM stations WHERE latitude IS NOT NULL) AS nb_stations_geolocalisees,
               (SELECT count(DISTINCT jour) FROM idx_serv) AS nb_jours_donnees,
               (SELECT count(*) FROM exc_serv WHERE depassement = 'alerte') AS nb_depassements_alerte,
               (SELECT count(*) FROM exc_serv WHERE depassement = 'info') AS nb_depassements_info""",
    "label_distribution": "SELECT qualificatif, count(*) AS n FROM idx_serv GROUP BY qualificatif",
    "day_stations": "SELECT * FROM ds",
    "mean_index": f"SELECT {RHU('coalesce(avg(indice), 0.0)', 1)} AS indice_moyen FROM ds",
    "count_by_pollutant": """
        SELECT polluant, count(*) AS nb FROM ds WHERE indice IS NOT NULL AND polluant IS NOT NULL AND polluant <> ''
        GROUP BY polluant""",
    "exceedances_by_pollutant": """
        SELECT code_polluant, count(*) AS nb FROM exc_serv WHERE code_polluant IS NOT NULL AND code_polluant <> ''
        GROUP BY code_polluant""",
    "exceedances_by_day": """
        SELECT jour, strftime(jour, '%m-%d') AS label, count(*) AS nb FROM exc_serv WHERE jour IS NOT NULL
        GROUP BY jour""",
    "stations_by_influence": """
        SELECT type_influence, count(*) AS nb FROM ds WHERE type_influence IS NOT NULL AND type_influence <> ''
        GROUP BY type_influence""",
    "good_share": f"""
        SELECT CAST({RHU("count(*) FILTER (WHERE qualificatif = 'Bon') * 100.0 / greatest(count(*), 1)", 0)}
               AS INTEGER) AS pct_bon FROM idx_serv""",
    "dominant_pollutant": """
        SELECT polluant, count(*) AS nb FROM ds WHERE indice IS NOT NULL AND polluant IS NOT NULL AND polluant <> ''
        GROUP BY polluant ORDER BY nb DESC, polluant LIMIT 1""",
    "total_exceedances": """
        SELECT count(*) FILTER (WHERE depassement IN ('alerte', 'info')) AS nb_depassements FROM exc_serv""",
    "most_exposed": """
        SELECT nom_site, moyenne, maximum, unite FROM means_serv
        WHERE code_polluant = 'NO2' AND moyenne IS NOT NULL
        ORDER BY moyenne DESC, jour DESC NULLS FIRST, code_site, nom_site, unite LIMIT 15""",
    "station_ranking": """
        SELECT CAST(row_number() OVER (ORDER BY indice DESC, code_station) AS INTEGER) AS rang, code_station, nom,
               polluant, indice,
               qualificatif
        FROM (SELECT * FROM ds WHERE indice IS NOT NULL ORDER BY indice DESC, code_station LIMIT 15)""",
    "worst_and_best": """
        (SELECT 'worst' AS kind, code_station, nom, indice, qualificatif, polluant FROM ds WHERE indice IS NOT NULL
         ORDER BY indice DESC, code_station LIMIT 1)
        UNION ALL
        (SELECT 'best' AS kind, code_station, nom, indice, qualificatif, polluant FROM ds WHERE indice IS NOT NULL
         ORDER BY indice ASC, code_station LIMIT 1)""",
    "filter_options": """
        SELECT DISTINCT 'polluant' AS kind, polluant AS value FROM ds WHERE polluant IS NOT NULL AND polluant <> ''
        UNION
        SELECT DISTINCT 'influence' AS kind, type_influence AS value FROM ds
        WHERE type_influence IS NOT NULL AND type_influence <> '' AND type_influence <> '—'""",
    "exceedance_table": """
        SELECT nom_site AS Station, code_polluant AS Polluant, horodatage AS Horodatage, valeur AS Valeur,
               unite AS Unite, depassement AS Niveau FROM exc_serv""",
    "recent_exceedances": """
        SELECT * FROM exc_serv
        ORDER BY horodatage DESC NULLS FIRST, code_site ASC NULLS LAST, code_polluant ASC NULLS LAST,
                 valeur DESC NULLS FIRST LIMIT 3""",
    "label_filter": "SELECT * FROM ds WHERE qualificatif = 'Moyen'",
    "station_search": """
        SELECT * FROM ds WHERE contains(lower(nom), 'supplier#') AND indice IN (1, 2, 3) AND polluant = 'NO2'
          AND type_influence = 'Industrielle'""",
    "display_attributes": """
        SELECT code_station, indice,
               coalesce(CASE indice WHEN 1 THEN '#50CCAA' WHEN 2 THEN '#50CCF0' WHEN 3 THEN '#F0E641'
                                    WHEN 4 THEN '#FF5050' WHEN 5 THEN '#960032' WHEN 6 THEN '#7D2181' END,
                        '#8A94A6') AS couleur,
               CASE WHEN indice IS NULL THEN CAST(5.0 AS DOUBLE)
                    ELSE CAST(5.0 AS DOUBLE) + CAST(0.8 AS DOUBLE) * least(indice, 6) END AS rayon
        FROM ds""",
    "localised_labels": """
        SELECT code_site, jour, indice_atmo,
               CASE indice_atmo WHEN 1 THEN 'Good' WHEN 2 THEN 'Fair' WHEN 3 THEN 'Degraded' WHEN 4 THEN 'Poor'
                                WHEN 5 THEN 'Very poor' WHEN 6 THEN 'Extremely poor' ELSE 'Not measured' END AS libelle
        FROM idx_serv""",
    # The labels of the six levels and of "not measured" in each language; other languages show the French ones.
    "localised_labels_all": """
        SELECT code_site, jour, indice_atmo, langue, coalesce(l.labels, f.labels)[CASE WHEN indice_atmo BETWEEN 1 AND 6 THEN indice_atmo ELSE 7 END] AS libelle
        FROM idx_serv CROSS JOIN (VALUES ('fr'), ('en'), ('ja'), ('es'), ('de'), ('zh'), ('pt'), ('yo'), ('it')) AS w(langue)
        LEFT JOIN labels l USING (langue) JOIN labels f ON f.langue = 'fr'""",
    "normalised_index_records": "SELECT * FROM idx_norm",
    "question_routing": f"""
        SELECT r.conv_id, r.turn,
               coalesce(r.intent, CASE WHEN c.code_station IS NOT NULL THEN 'city' END, 'default') AS intent,
               CASE WHEN r.intent IS NULL THEN c.code_station END AS code_station
        FROM (SELECT conv_id, turn, {INTENT} AS intent
              FROM (SELECT conv_id, turn, lower(coalesce(question, '')) AS q,
                           EXISTS (SELECT 1 FROM ds WHERE indice IS NOT NULL) AS has_index
                    FROM questions)) r
        LEFT JOIN city c ON r.conv_id = c.conv_id AND r.turn = c.turn""",
    "city_lookup": "SELECT * FROM city",
    "distinct_stations": "SELECT * FROM st_distinct",
    "geocoded_stations": "SELECT * FROM st_geo",
    "geocoded_approximate": """
        SELECT m.* EXCLUDE (name, kind), b.commune_label, b.contexte, b.longitude, b.latitude, b.edits, b.par,
               (b.latitude IS NOT NULL AND b.longitude IS NOT NULL) AS geocode_ok
        FROM misspelt m LEFT JOIN best_place b USING (name)""",
    "station_geometry": """
        SELECT code_station,
               CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN longitude END AS geom_lon,
               CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN latitude END AS geom_lat,
               CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN 4326 END AS geom_srid
        FROM stations""",
    "station_upsert": "SELECT * FROM station_merged",
    "pollutant_dimension": """
        SELECT * FROM pollutant_seed WHERE code_polluant IN (SELECT code_polluant FROM depassements)
        UNION ALL
        SELECT * FROM pollutant_seed WHERE code_polluant NOT IN (SELECT code_polluant FROM depassements)""",
    "geocoding_coverage": """
        SELECT count(DISTINCT CASE WHEN geocode_ok THEN lower(commune_extraite) END) AS communes_localisees,
               count(DISTINCT lower(commune_extraite)) AS communes_total,
               count(*) FILTER (WHERE geocode_ok) AS stations_localisees,
               count(*) AS stations_total,
               CASE WHEN count(*) > 0 THEN CAST(floor(count(*) FILTER (WHERE geocode_ok) * 100 / count(*)) AS BIGINT)
               END AS pct_stations_localisees
        FROM st_geo""",
    "uniqueness_report": """
        SELECT 'indice_site_jour' AS regle, count(*) AS cles_dupliquees, CAST(coalesce(sum(n), 0) AS BIGINT) AS lignes
        FROM (SELECT count(*) AS n FROM idx_serv GROUP BY code_site, jour HAVING count(*) > 1)
        UNION ALL
        SELECT 'moyennes_site_polluant_jour', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM means_serv GROUP BY code_site, code_polluant, jour HAVING count(*) > 1)
        UNION ALL
        SELECT 'mesure_station_polluant_heure', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM typed WHERE validite <> '-1' GROUP BY code_site, code_polluant, horodatage HAVING count(*) > 1)""",
    "referential_report": """
        SELECT 'station_region' AS regle, count(*) AS orphelins FROM station_merged
        WHERE code_region IS NOT NULL AND code_region NOT IN (SELECT code_region FROM regions WHERE code_region IS NOT NULL)
        UNION ALL
        SELECT 'mesure_station', count(*) FROM typed
        WHERE validite <> '-1' AND code_site IS NOT NULL AND code_site NOT IN (SELECT code_station FROM station_base)
        UNION ALL
        SELECT 'source_polluant', count(*) FROM labelled
        WHERE label IS NOT NULL AND label NOT IN (SELECT code_polluant FROM pollutant_seed)""",
    "not_null_report": """
        SELECT 'station' AS "table", 'code_station' AS colonne, count(*) FILTER (WHERE code_station IS NULL) AS nulls
        FROM station_merged
        UNION ALL SELECT 'station', 'nom', count(*) FILTER (WHERE nom IS NULL) FROM station_merged
        UNION ALL SELECT 'region', 'code_region', count(*) FILTER (WHERE code_region IS NULL) FROM regions
        UNION ALL SELECT 'region', 'nom', count(*) FILTER (WHERE nom IS NULL) FROM regions
        UNION ALL SELECT 'polluant', 'code_polluant', count(*) FILTER (WHERE code_polluant IS NULL) FROM pollutant_seed
        UNION ALL SELECT 'polluant', 'libelle', count(*) FILTER (WHERE libelle IS NULL) FROM pollutant_seed
        UNION ALL SELECT 'polluant', 'unite', count(*) FILTER (WHERE unite IS NULL) FROM pollutant_seed
        UNION ALL SELECT 'mesure', 'code_site', count(*) FILTER (WHERE code_site IS NULL) FROM silver
        UNION ALL SELECT 'mesure', 'horodatage', count(*) FILTER (WHERE horodatage IS NULL) FROM silver
        UNION ALL SELECT 'indice', 'jour', count(*) FILTER (WHERE jour IS NULL) FROM idx_serv""",
    "text_length_report": """
        SELECT 'indice' AS "table", 'code_site' AS colonne, count(*) FILTER (WHERE length(code_site) > 20) AS trop_longs FROM idx_serv
        UNION ALL SELECT 'indice', 'nom_site', count(*) FILTER (WHERE length(nom_site) > 200) FROM idx_serv
        UNION ALL SELECT 'indice', 'qualificatif', count(*) FILTER (WHERE length(qualificatif) > 40) FROM idx_serv
        UNION ALL SELECT 'indice', 'polluant_resp', count(*) FILTER (WHERE length(polluant_resp) > 10) FROM idx_serv
        UNION ALL SELECT 'moyennes', 'code_site', count(*) FILTER (WHERE length(code_site) > 20) FROM means_serv
        UNION ALL SELECT 'moyennes', 'nom_site', count(*) FILTER (WHERE length(nom_site) > 200) FROM means_serv
        UNION ALL SELECT 'moyennes', 'code_polluant', count(*) FILTER (WHERE length(code_polluant) > 10) FROM means_serv
        UNION ALL SELECT 'moyennes', 'unite', count(*) FILTER (WHERE length(unite) > 20) FROM means_serv
        UNION ALL SELECT 'depassements', 'code_site', count(*) FILTER (WHERE length(code_site) > 20) FROM exc_serv
        UNION ALL SELECT 'depassements', 'nom_site', count(*) FILTER (WHERE length(nom_site) > 200) FROM exc_serv
        UNION ALL SELECT 'depassements', 'code_polluant', count(*) FILTER (WHERE length(code_polluant) > 10) FROM exc_serv
        UNION ALL SELECT 'depassements', 'unite', count(*) FILTER (WHERE length(unite) > 20) FROM exc_serv
        UNION ALL SELECT 'depassements', 'depassement', count(*) FILTER (WHERE length(depassement) > 10) FROM exc_serv
        UNION ALL SELECT 'station', 'code_station', count(*) FILTER (WHERE length(code_station) > 20) FROM station_merged
        UNION ALL SELECT 'station', 'nom', count(*) FILTER (WHERE length(nom) > 200) FROM station_merged
        UNION ALL SELECT 'station', 'code_region', count(*) FILTER (WHERE length(code_region) > 3) FROM station_merged
        UNION ALL SELECT 'station', 'type_station', count(*) FILTER (WHERE length(type_station) > 40) FROM station_merged
        UNION ALL SELECT 'station', 'type_influence', count(*) FILTER (WHERE length(type_influence) > 40) FROM station_merged
        UNION ALL SELECT 'region', 'code_region', count(*) FILTER (WHERE length(code_region) > 3) FROM regions
        UNION ALL SELECT 'region', 'nom', count(*) FILTER (WHERE length(nom) > 120) FROM regions
        UNION ALL SELECT 'polluant', 'code_polluant', count(*) FILTER (WHERE length(code_polluant) > 10) FROM pollutant_seed
        UNION ALL SELECT 'polluant', 'libelle', count(*) FILTER (WHERE length(libelle) > 80) FROM pollutant_seed
        UNION ALL SELECT 'polluant', 'unite', count(*) FILTER (WHERE length(unite) > 20) FROM pollutant_seed""",
    "non_empty_report": """
        SELECT 'moyennes_journalieres' AS mart, count(*) AS lignes, count(*) > 0 AS ok FROM means
        UNION ALL SELECT 'indice_journalier', count(*), count(*) > 0 FROM indice
        UNION ALL SELECT 'depassements', count(*), count(*) > 0 FROM depassements""",
    "published_messages": """
        SELECT code_site || '|' || code_polluant AS key,
               to_json({'date_debut': date_debut, 'date_fin': date_fin, 'organisme': organisme, 'code_zas': code_zas,
                        'zas': zas, 'code_site': code_site, 'nom_site': nom_site,
                        'type_implantation': type_implantation, 'polluant_source': polluant_source,
                        'code_polluant': code_polluant, 'type_influence': type_influence,
                        'type_valeur': type_valeur, 'valeur': valeur, 'valeur_brute': valeur_brute,
                        'unite_source': unite_source, 'unite': unite, 'code_qualite': code_qualite,
                        'validite': validite, '_ingested_at': _ingested_at})::VARCHAR AS value
        FROM bronze""",
    "bronze_from_messages": "SELECT * FROM bronze",
    "csv_records": "SELECT * EXCLUDE (_ingested_at), '2024-02-01T00:00:00.000000Z' AS _ingested_at FROM bronze",
}


def _judged(source: str, rules: list[tuple[str, str]], unique: tuple[str, ...] = (), order: str = "") -> str:
    """All rows of ``source`` with the reasons of broken rules; rows that break none compete for the ``unique`` key."""
    reasons = ", ".join(f"CASE WHEN {broken} THEN '{reason}' END" for broken, reason in rules)
    own = f"SELECT *, concat_ws(';', {reasons}) AS own FROM {source}"
    if not unique:
        return f"SELECT * EXCLUDE (own), own AS motifs FROM ({own})"
    competes = " AND ".join(["own = ''", *(f"{c} IS NOT NULL" for c in unique)])
    return f"""SELECT * EXCLUDE (own, competes, place), CASE WHEN competes AND place > 1 THEN 'doublon:{','.join(unique)}' ELSE own END AS motifs
        FROM (SELECT *, row_number() OVER (PARTITION BY competes, {', '.join(unique)} ORDER BY {order}) AS place
              FROM (SELECT *, {competes} AS competes FROM ({own})))"""


def _too_long(**limits: int) -> list[tuple[str, str]]:
    return [(f"length({c}) > {n}", f"trop_long:{c}") for c, n in limits.items()]


JUDGED_INDEX = _judged("idx_serv", _too_long(code_site=20, nom_site=200, qualificatif=40, polluant_resp=10) + [("indice_atmo NOT BETWEEN -32768 AND 32767", "hors_bornes:indice_atmo")],
                       ("code_site", "jour"), "nom_site, indice_atmo, qualificatif, polluant_resp, latitude, longitude")
JUDGED_MEANS = _judged("means_serv", _too_long(code_site=20, nom_site=200, code_polluant=10, unite=20) + [("nb_mesures NOT BETWEEN -2147483648 AND 2147483647", "hors_bornes:nb_mesures")],
                       ("code_site", "code_polluant", "jour"), "nom_site, moyenne, minimum, maximum, nb_mesures, unite")
HOURLY = """(SELECT t.code_site AS code_station, t.code_polluant, horodatage, valeur_num AS valeur, TRY_CAST(nullif(validite, '') AS SMALLINT) AS validite,
    CASE WHEN th.alerte IS NOT NULL AND valeur_num >= th.alerte THEN 'alerte' WHEN th.info IS NOT NULL AND valeur_num >= th.info THEN 'info' END AS depassement, _ingested_at
  FROM typed t LEFT JOIN (VALUES ('NO2', 200.0, 400.0), ('O3', 180.0, 240.0), ('PM10', 50.0, 80.0), ('SO2', 300.0, 500.0)) AS th(code, info, alerte) ON t.code_polluant = th.code
  WHERE validite <> '-1')"""

SELECTS |= {
    "accepted_index": f"SELECT * EXCLUDE (motifs) FROM ({JUDGED_INDEX}) WHERE motifs = ''",
    "quarantined_index": f"SELECT * FROM ({JUDGED_INDEX}) WHERE motifs <> ''",
    "accepted_means": f"SELECT * EXCLUDE (motifs) FROM ({JUDGED_MEANS}) WHERE motifs = ''",
    "quarantined_means": f"SELECT * FROM ({JUDGED_MEANS}) WHERE motifs <> ''",
    "judged_exceedances": _judged("exc_serv", _too_long(code_site=20, nom_site=200, code_polluant=10, unite=20, depassement=10)),
    "judged_stations": _judged("station_merged", [("code_station IS NULL", "manquant:code_station"), ("nom IS NULL", "manquant:nom")]
                               + _too_long(code_station=20, nom=200, code_region=3, type_station=40, type_influence=40)
                               + [("code_region IS NOT NULL AND code_region NOT IN (SELECT code_region FROM regions WHERE code_region IS NOT NULL)", "sans_parent:code_region")],
                               ("code_station",), "nom"),
    "judged_measurements": _judged(HOURLY, [("horodatage IS NULL", "manquant:horodatage")] + _too_long(code_station=20, code_polluant=10, depassement=10)
                                   + [("code_station NOT IN (SELECT code_station FROM station_base)", "sans_parent:code_station"),
                                      ("code_polluant NOT IN (SELECT code_polluant FROM pollutant_seed)", "sans_parent:code_polluant")],
                                   ("code_station", "code_polluant", "horodatage"), "_ingested_at, valeur, validite, depassement"),
}


def oracle_sql() -> dict[str, str]:
    more = {"geocoded_approximate": MISSPELT, "localised_labels_all": LABELS}
    return {name: f"WITH {BASE}{more.get(name, '')}\n{sel}" for name, sel in SELECTS.items()}
