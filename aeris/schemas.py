"""Explicit schemas (no inference on the hot path)."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, StringType, StructField, StructType,
)

# FIXED VALUES: the 23 text columns of the daily source CSV, in file order.
SOURCE_COLUMNS: list[str] = [
    "Date de début", "Date de fin", "Organisme", "code zas", "Zas", "code site", "nom site",
    "type d'implantation", "Polluant", "type d'influence", "discriminant", "Réglementaire",
    "type d'évaluation", "procédure de mesure", "type de valeur", "valeur", "valeur brute",
    "unité de mesure", "taux de saisie", "couverture temporelle", "couverture de données",
    "code qualité", "validité",
]

SOURCE_SCHEMA = StructType([StructField(c, StringType(), True) for c in SOURCE_COLUMNS])

# Bronze record: all text, as landed from the stream.
BRONZE_COLUMNS: list[str] = [
    "date_debut", "date_fin", "organisme", "code_zas", "zas", "code_site", "nom_site",
    "type_implantation", "polluant_source", "code_polluant", "type_influence", "type_valeur",
    "valeur", "valeur_brute", "unite_source", "unite", "code_qualite", "validite", "_ingested_at",
]
BRONZE_SCHEMA = StructType([StructField(c, StringType(), True) for c in BRONZE_COLUMNS])

SILVER_COLUMNS: list[str] = [
    "code_site", "nom_site", "organisme", "code_zas", "zas", "type_implantation", "type_influence",
    "code_polluant", "horodatage", "horodatage_fin", "date_mesure", "valeur", "unite", "type_valeur",
    "validite", "depassement", "_ingested_at",
]

STATION_SCHEMA = StructType([
    StructField("code_station", StringType(), False), StructField("nom", StringType(), False),
    StructField("code_region", StringType()), StructField("type_station", StringType()),
    StructField("type_influence", StringType()), StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
])

GAZETTEER_SCHEMA = StructType([
    StructField("commune", StringType()), StructField("label", StringType()),
    StructField("contexte", StringType()), StructField("longitude", DoubleType()),
    StructField("latitude", DoubleType()),
])

POLLUTANT_SCHEMA = StructType([
    StructField("code_polluant", StringType(), False), StructField("libelle", StringType(), False),
    StructField("unite", StringType(), False), StructField("seuil_info", DoubleType()),
    StructField("seuil_alerte", DoubleType()),
])

# Serving contracts (column order of the serving tables).
SERVING_INDEX_COLUMNS = ["code_site", "nom_site", "jour", "indice_atmo", "qualificatif", "polluant_resp",
                         "latitude", "longitude"]
SERVING_MEANS_COLUMNS = ["code_site", "nom_site", "code_polluant", "jour", "moyenne", "minimum", "maximum",
                         "nb_mesures", "unite"]
SERVING_EXCEEDANCE_COLUMNS = ["code_site", "nom_site", "code_polluant", "horodatage", "jour", "valeur", "unite",
                              "depassement"]

# Declared text limits of the serving tables (VARCHAR n), checked by V4.
TEXT_LIMITS: dict[str, dict[str, int]] = {
    "indice": {"code_site": 20, "nom_site": 200, "qualificatif": 40, "polluant_resp": 10},
    "moyennes": {"code_site": 20, "nom_site": 200, "code_polluant": 10, "unite": 20},
    "depassements": {"code_site": 20, "nom_site": 200, "code_polluant": 10, "unite": 20, "depassement": 10},
    "region": {"code_region": 3, "nom": 120},
    "polluant": {"code_polluant": 10, "libelle": 80, "unite": 20},
    "station": {"code_station": 20, "nom": 200, "code_region": 3, "type_station": 40, "type_influence": 40},
}
