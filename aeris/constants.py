"""Domain constants.

FIXED VALUES: everything in this module must equal the reference domain rules
(regulated pollutants, unit spellings, regulatory thresholds, the six-level
index grid and labels, station-name word lists, localised labels). They are
stated plainly and in their natural order; do not edit them to tune results.
"""

from __future__ import annotations

# --- FIXED VALUES: source pollutant label -> internal code (the 6 regulated ones)
POLLUTANT_CODES: dict[str, str] = {
    "NO2": "NO2",
    "O3": "O3",
    "PM10": "PM10",
    "PM2.5": "PM25",
    "SO2": "SO2",
    "CO": "CO",
}

# --- FIXED VALUES: unit spelling normalisation (unknown units pass through)
UNIT_NORMALISATION: dict[str, str] = {
    "µg-m3": "ug/m3",
    "µg/m3": "ug/m3",
    "mg-m3": "mg/m3",
}

# --- FIXED VALUES: regulatory thresholds per pollutant, (information, alert); None = no threshold
THRESHOLDS: dict[str, tuple[float | None, float | None]] = {
    "NO2": (200.0, 400.0),
    "O3": (180.0, 240.0),
    "PM10": (50.0, 80.0),
    "PM25": (None, None),
    "SO2": (300.0, 500.0),
    "CO": (None, None),
}

# --- FIXED VALUES: inclusive upper bound of sub-index levels 1..5 per pollutant (level 6 = above)
INDEX_GRID: dict[str, tuple[float, float, float, float, float]] = {
    "NO2": (40, 90, 120, 230, 340),
    "O3": (50, 100, 130, 240, 380),
    "PM10": (20, 40, 50, 100, 150),
    "PM25": (10, 20, 25, 50, 75),
    "SO2": (100, 200, 350, 500, 750),
    "CO": (4, 8, 10, 15, 30),
}
INDEX_LEVELS = 6

# --- FIXED VALUES: index label per level 1..6
INDEX_LABELS: dict[int, str] = {
    1: "Bon",
    2: "Moyen",
    3: "Degrade",
    4: "Mauvais",
    5: "Tres mauvais",
    6: "Extremement mauvais",
}

# --- FIXED VALUES: pollutant dimension seed rows (code, label, unit, info threshold, alert threshold)
POLLUTANT_SEED: list[tuple[str, str, str, float | None, float | None]] = [
    ("NO2", "Dioxyde d'azote", "ug/m3", 200.0, 400.0),
    ("O3", "Ozone", "ug/m3", 180.0, 240.0),
    ("PM10", "Particules < 10um", "ug/m3", 50.0, 80.0),
    ("PM25", "Particules fines < 2.5um", "ug/m3", None, None),
    ("SO2", "Dioxyde de soufre", "ug/m3", 300.0, 500.0),
    ("CO", "Monoxyde de carbone", "mg/m3", None, None),
]

# --- FIXED VALUES: station-name words that are not a commune (compared lower-case)
NOISE_WORDS: tuple[str, ...] = (
    "periurbaine", "periurb", "urbain", "urbaine", "rurale", "trafic",
    "stade", "mairie", "zi", "za", "rocade", "sud", "nord", "est", "ouest",
    "boulevards", "centre", "peripherique", "autoroute", "zone", "parc",
)
# --- FIXED VALUES: first-token pattern of road codes and industrial zones (case-insensitive)
NON_COMMUNE_PATTERN = r"^(a\d+|n\d+|d\d+|rd\d+|zi|za)$"
# --- FIXED VALUES: first words that start a compound commune name (compared lower-case)
COMPOUND_PREFIXES: tuple[str, ...] = ("st", "saint", "sainte", "ste", "le", "la", "les", "aix")
# --- FIXED VALUES: zone-name prefixes removed, in this order, anywhere in the text
ZONE_PREFIXES: tuple[str, ...] = ("ZAG", "ZAR", "ZA ")

# --- FIXED VALUES: display colour per index level, grey when unknown
INDEX_COLOURS: dict[int, str] = {
    1: "#50CCAA", 2: "#50CCF0", 3: "#F0E641", 4: "#FF5050", 5: "#960032", 6: "#7D2181",
}
UNKNOWN_COLOUR = "#8A94A6"

# --- FIXED VALUES: localised index labels per language, levels 1..6 then "unknown"
LOCALISED_LABELS: dict[str, tuple[str, str, str, str, str, str, str]] = {
    "fr": ("Bon", "Moyen", "Dégradé", "Mauvais", "Très mauvais", "Extrêmement mauvais", "Non mesuré"),
    "en": ("Good", "Fair", "Degraded", "Poor", "Very poor", "Extremely poor", "Not measured"),
    "es": ("Buena", "Media", "Degradada", "Mala", "Muy mala", "Extremadamente mala", "No medida"),
    "de": ("Gut", "Mäßig", "Verschlechtert", "Schlecht", "Sehr schlecht", "Extrem schlecht", "Nicht gemessen"),
    "ja": ("良好", "普通", "やや悪い", "悪い", "非常に悪い", "極めて悪い", "未測定"),
    "zh": ("优", "良", "轻度污染", "中度污染", "重度污染", "严重污染", "未测量"),
    "pt": ("Boa", "Média", "Degradada", "Má", "Muito má", "Extremamente má", "Não medida"),
    "yo": ("Dáradára", "Àárín", "Dínkù", "Búburú", "Búburú gan", "Búburú púpọ̀", "Kò wọ̀n"),
}

# --- FIXED VALUES: keyword lists of the question router, in rule order (first match wins)
INTENT_RULES: list[tuple[str, tuple[str, ...], tuple[str, ...]]] = [
    # (intent, any-of words, and also any-of words; empty = no second condition)
    ("count", ("combien", "how many", "cuánt", "wie viele", "quant", "mélòó", "多少", "何"),
     ("station", "esta", "地点", "站", "ibùdó")),
    ("alerts", ("alerte", "alert", "警報", "警报", "alarm", "ìkìlọ̀", "excede", "dépass", "超過", "超标", "überschr"), ()),
    ("worst", ("plus pollu", "most pollut", "汚染", "污染", "contamin", "bàjẹ́", "schlecht", "belast", "pire", "worst"), ()),
    ("best", ("meilleur", "best", "moins pollu", "cleanest", "最も良い", "最好", "mejor", "beste", "melhor"), ()),
    ("pollutant", ("polluant", "pollutant", "汚染物質", "污染物", "contaminante", "schadstoff", "poluente"), ()),
    ("quality", ("qualité", "quality", "質", "质量", "calidad", "qualidade", "ìmọ́tótó", "luftqual", "aujourd", "today",
                 "hoy", "heute", "lónìí", "今日", "今天", "état", "situation"), ()),
    ("greeting", ("bonjour", "salut", "hello", "hi ", "hola", "こんにち", "你好", "olá", "ẹ nlẹ", "hallo", "merci",
                  "thanks", "gracias"), ()),
    ("help", ("aide", "help", "que peux", "what can", "ayuda", "hilfe", "何ができ", "能做什么", "ajuda"), ()),
]
# Intents whose answer needs data; when the data is missing the router falls through to the next rule.
DATA_DEPENDENT_INTENTS = ("best", "pollutant")

# Station names whose first word is at most this long are never matched in questions.
CITY_WORD_MIN_LENGTH = 4

# Placeholder shown for a missing station attribute.
MISSING_MARK = "—"

# Commune partition value for records without a usable start date.
UNKNOWN_DATE = "inconnue"

# Source timestamps: yyyy/MM/dd HH:mm:ss.
SOURCE_TS_PATTERN = r"^[0-9]{4}/[0-9]{2}/[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
