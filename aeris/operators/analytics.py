"""Dashboard / assistant analytics over the serving tables (D2, D6, C7, C8, E7-E13, E16,
F7-F10, F12, F13, G1, B17-B19).

The web view works on one day ("the stations"): the located indices of that day joined
to the station attributes. The day is a parameter, such as the latest day, found by
a scalar subquery rather than a driver round-trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.constants import CITY_WORD_MIN_LENGTH, MISSING_MARK
from aeris.functions import (
    first_non_empty, index_colour, localised_label, marker_radius, missing_as_mark, question_intent,
)
from aeris.operators.joins import left_join_dimension

RANKING_SIZE = 15
TOP_EXPOSED = 15

PIECE = 256  # letters of a long token
FILTER_BITS = 1 << 20  # of the station words' filter: 128 KB


def normalise_index_records(index_like: DataFrame) -> DataFrame:
    """Accept either field naming, default name ``Station``, empty -> NULL."""
    cols = set(index_like.columns)

    def pick(*names):
        present = [n for n in names if n in cols]
        return present

    def val(names, default=None):
        p = pick(*names)
        if not p:
            return F.lit(default)
        return first_non_empty(*p, default=default)

    ind = [n for n in ("indice_atmo", "indice") if n in cols]
    return index_like.select(
        val(("code_site", "code_station")).alias("code_station"),
        val(("nom_site", "nom"), default="Station").alias("nom"),
        (F.coalesce(*[F.col(n) for n in ind]) if ind else F.lit(None)).cast("int").alias("indice"),
        val(("qualificatif",)).alias("qualificatif"),
        val(("polluant_resp", "polluant")).alias("polluant"),
        F.col("latitude"), F.col("longitude"), F.col("jour"),
        *[F.col(c) for c in ("_ts", "_ti") if c in cols])


def latest_measurement_day(measurements: DataFrame) -> Column:
    """The latest day with measurements, as a scalar subquery. Every dated Silver row yields a
    daily mean and an index row, so this equals the latest index day. The deduplication keeps a
    survivor for every (site, pollutant, hour) and the day is a function of the hour, so valid rows
    *before* deduplication give the same maximum: a scan with a partial ``max``."""
    return measurements.select(F.max("date_mesure")).scalar()


def day_stations(index: DataFrame, stations: DataFrame) -> DataFrame:
    """The located station indices of one day, with station type and influence (missing or
    empty -> the placeholder mark). ``index`` is the daily index of that day; coordinates and attributes come from
    one left join to the station table (codes are unique there)."""
    st = stations.select(F.col("code_station").alias("code_site"), "latitude", "longitude",
                         F.col("type_station").alias("_ts"), F.col("type_influence").alias("_ti"))
    j = left_join_dimension(index.withColumnRenamed("date_mesure", "jour"), st, "code_site")
    j = j.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    idx = normalise_index_records(j)
    base = [c for c in idx.columns if c not in ("_ts", "_ti")]
    return idx.select(*base, missing_as_mark(F.col("_ts")).alias("type_station"),
                      missing_as_mark(F.col("_ti")).alias("type_influence"))


def with_display(ds: DataFrame) -> DataFrame:
    """Colour and marker radius per station."""
    return ds.select("code_station", "indice", index_colour("indice").alias("couleur"),
                     marker_radius("indice").alias("rayon"))


def with_localised_label(index_serving: DataFrame, lang: str = "en") -> DataFrame:
    """Localised label of each index."""
    return index_serving.select("code_site", "jour", "indice_atmo",
                                localised_label("indice_atmo", F.lit(lang)).alias("libelle"))


def with_localised_labels(index_serving: DataFrame, langs: Sequence[str]) -> DataFrame:
    """B19 in several languages: a row for each index and language."""
    rows = index_serving.select("code_site", "jour", "indice_atmo", F.explode(F.array(*map(F.lit, langs))).alias("langue"))
    return rows.withColumn("libelle", localised_label("indice_atmo", "langue"))


def label_filter(ds: DataFrame, label: str | None) -> DataFrame:
    """Keep one label; ``Tous`` (or nothing) keeps everything."""
    if not label or label == "Tous":
        return ds
    return ds.filter(F.col("qualificatif") == label)


def search_stations(ds: DataFrame, text: str | None = None, qualities: list[int] | None = None,
                    pollutant: str | None = None, influence: str | None = None) -> DataFrame:
    """Case-insensitive name substring AND index in set AND pollutant AND influence,
    each optional."""
    if text:
        ds = ds.filter(F.lower(F.col("nom")).contains(text.lower()))
    if qualities:
        ds = ds.filter(F.col("indice").isin(*qualities))
    if pollutant:
        ds = ds.filter(F.col("polluant") == pollutant)
    if influence:
        ds = ds.filter(F.col("type_influence") == influence)
    return ds


def mean_index(ds: DataFrame) -> DataFrame:
    """Mean index over stations with an index, one decimal, 0 when there is none."""
    return ds.agg(F.round(F.coalesce(F.avg("indice"), F.lit(0.0)), 1).alias("indice_moyen"))


def count_by_pollutant(ds: DataFrame) -> DataFrame:
    """Stations per responsible pollutant (NULL / empty skipped), most frequent first."""
    return (ds.filter(F.col("indice").isNotNull() & F.col("polluant").isNotNull() & (F.col("polluant") != ""))
            .groupBy("polluant").agg(F.count(F.lit(1)).alias("nb"))
            .orderBy(F.col("nb").desc(), F.col("polluant").asc()))


def exceedances_by_pollutant(exc: DataFrame) -> DataFrame:
    """Exceedances per pollutant, most frequent first."""
    return (exc.filter(F.col("code_polluant").isNotNull() & (F.col("code_polluant") != ""))
            .groupBy("code_polluant").agg(F.count(F.lit(1)).alias("nb"))
            .orderBy(F.col("nb").desc(), F.col("code_polluant").asc()))


def exceedances_by_day(exc: DataFrame) -> DataFrame:
    """Exceedances per day with the ``MM-dd`` label, in date order."""
    return (exc.filter(F.col("jour").isNotNull()).groupBy("jour").agg(F.count(F.lit(1)).alias("nb"))
            .select("jour", F.date_format("jour", "MM-dd").alias("label"), "nb")
            .orderBy("jour"))


def stations_by_influence(ds: DataFrame) -> DataFrame:
    """Stations per influence type (the placeholder mark counts as a type)."""
    return (ds.filter(F.col("type_influence").isNotNull() & (F.col("type_influence") != ""))
            .groupBy("type_influence").agg(F.count(F.lit(1)).alias("nb")))


def good_share(index_serving: DataFrame) -> DataFrame:
    """Integer percent (half up) of ``Bon`` station-days over all station-days of the
    label distribution (the NULL-label group counts in the total); 0 when there is none."""
    return index_serving.agg(
        F.round(F.count_if(F.col("qualificatif") == "Bon") * 100.0
                / F.greatest(F.count(F.lit(1)), F.lit(1)), 0).cast("int").alias("pct_bon"))


def dominant_pollutant(ds: DataFrame) -> DataFrame:
    """The most frequent responsible pollutant and its station count (ties: alphabetical)."""
    return count_by_pollutant(ds).limit(1)


def total_exceedances(exceedances: DataFrame) -> DataFrame:
    """Alert + info exceedances."""
    return exceedances.agg(F.count_if(F.col("depassement").isin("alerte", "info")).alias("nb_depassements"))


def most_exposed(means_serving: DataFrame, pollutant: str, n: int = TOP_EXPOSED) -> DataFrame:
    """``n`` highest daily means of a pollutant, over the whole table."""
    return (means_serving.filter((F.col("code_polluant") == pollutant) & F.col("moyenne").isNotNull())
            .orderBy(F.col("moyenne").desc(), F.col("jour").desc_nulls_first(), F.col("code_site").asc(),
                     F.col("nom_site").asc_nulls_last(), F.col("unite").asc_nulls_last())
            .select("nom_site", "moyenne", "maximum", "unite").limit(n))


def ranking(ds: DataFrame, n: int = RANKING_SIZE) -> DataFrame:
    """F8: the ``n`` stations with the highest index; rank = position (ties by code).
    The top-k runs distributed; only the ``n`` survivors are numbered."""
    top = (ds.filter(F.col("indice").isNotNull())
           .orderBy(F.col("indice").desc(), F.col("code_station").asc()).limit(n))
    return top.select(
        F.row_number().over(_ordered_window()).alias("rang"),
        "code_station", "nom", "polluant", "indice", "qualificatif")


def _ordered_window():
    from pyspark.sql import Window
    return Window.orderBy(F.col("indice").desc(), F.col("code_station").asc())


def worst_and_best(ds: DataFrame) -> DataFrame:
    """the station with the highest index and the one with the lowest (ties by code), in one aggregate."""
    cols = ["code_station", "nom", "indice", "qualificatif", "polluant"]
    row = F.struct(*cols)
    by = lambda sign: F.struct((sign * F.col("indice")).alias("indice"), *[c for c in cols if c != "indice"])
    ends = ds.filter(F.col("indice").isNotNull()).agg(F.min_by(row, by(-1)).alias("worst"), F.min_by(row, by(1)).alias("best"))
    return (ends.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("r")) for k in ("worst", "best")])).alias("e"))
            .filter(F.col("e.r").isNotNull()).select("e.kind", "e.r.*"))


def filter_options(ds: DataFrame) -> DataFrame:
    """distinct pollutants and influences (without the placeholder) offered as filters, in one pass."""
    options = F.explode(F.array(
        F.struct(F.lit("polluant").alias("kind"), F.col("polluant").alias("value")),
        F.struct(F.lit("influence").alias("kind"), F.nullif(F.col("type_influence"), F.lit(MISSING_MARK)).alias("value"))))
    return (ds.select(options.alias("o")).select("o.*").filter(F.col("value") != "").distinct().orderBy("kind", "value"))


def exceedance_table(exc_rows: DataFrame) -> DataFrame:
    """exceedance rows with display column names."""
    return exc_rows.select(F.col("nom_site").alias("Station"), F.col("code_polluant").alias("Polluant"),
                           F.col("horodatage").alias("Horodatage"), F.col("valeur").alias("Valeur"),
                           F.col("unite").alias("Unite"), F.col("depassement").alias("Niveau"))


def recent_exceedances(exc_list: DataFrame, n: int = 3) -> DataFrame:
    """the ``n`` most recent exceedances of the (ordered) exceedance list."""
    return exc_list.limit(n)


def station_words(ds: DataFrame) -> DataFrame:
    """The best station for each first name word that is long enough to be looked up: the first in view
    order (index DESC with NULLs first, then code). Stations that share a word are reduced here, before any join."""
    word = F.get(F.split(F.lower(F.col("nom")), " "), 0)
    rank = F.struct(F.col("indice").isNotNull().alias("has"), (-F.col("indice")).alias("neg"), F.col("code_station").alias("code"))
    return (ds.withColumn("mot", word).filter((F.col("nom") != "") & (F.length("mot") >= CITY_WORD_MIN_LENGTH))
            .groupBy("mot").agg(F.min(F.struct(rank.alias("rank"), "code_station", "nom")).alias("s"))
            .select("mot", "s.*"))


def word_filter(words: DataFrame) -> tuple[Column, Column]:
    """What the distinct station words (``mot``) let through, as scalar subqueries over one aggregate: the lengths that they have (as many
    as the longest has letters), and a filter of ``FILTER_BITS`` bits in which each word's hash has set one. A substring whose bit
    isn't set is no word; with so many words that most bits are set the filter lets more through, and the join still decides."""
    place = F.pmod(F.xxhash64("mot"), F.lit(FILTER_BITS))
    slots = words.select(F.length("mot").alias("n"), F.floor(place / 64).alias("slot"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(mot), {FILTER_BITS}) % 64 as int))").alias("bit"))
    slots = slots.groupBy("slot").agg(F.bit_or("bit").alias("bits"), F.collect_set("n").alias("lengths"))
    every = words.sparkSession.range(FILTER_BITS // 64).join(slots, F.col("id") == F.col("slot"), "left")
    row = every.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("lengths")))).alias("lengths"),
                    F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))), lambda x: x["bits"]).alias("bits"))
    return row.select("lengths").scalar(), row.select("bits").scalar()


def may_be_word(word: Column, bits: Column) -> Column:
    place = F.pmod(F.xxhash64(word), F.lit(FILTER_BITS))
    return F.bit_get(F.element_at(bits, (F.floor(place / 64) + 1).cast("int")), (place % 64).cast("int")) == 1


def city_lookup(questions: DataFrame, ds: DataFrame, text_col: str = "question",
                key_cols: tuple[str, ...] = ("conv_id", "turn")) -> DataFrame:
    """For each question, the first station (view order) whose first name word occurs
    in the lower-cased text. Questions without a match are absent.

    Exact, without evaluating (question, station) pairs: a station word has no space, so it can only occur
    inside a space-separated token of the question. Each distinct token puts out its substrings of the lengths that
    station words have, one by one; a filter of the words' hashes drops nearly all that are none before anything is shuffled, and
    the rest meet the words in an equi-join on the whole word, so a common beginning of many names is no hot key."""
    words = station_words(ds)
    lengths, bits = word_filter(words)
    tokens = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), " "))
    q = questions.select(*key_cols, F.explode(tokens).alias("_t")).filter(F.length("_t") >= CITY_WORD_MIN_LENGTH)
    # a long token in pieces that overlap by the longest word: a substring is found by counting letters from the start
    q = q.withColumn("_lengths", lengths).withColumn("_from", F.explode(F.expr(f"sequence(0, (length(_t) - 1) div {PIECE})")))
    q = q.withColumn("_t", F.expr(f"substring(_t, cast(_from * {PIECE} + 1 as int), {PIECE - 1} + array_max(_lengths))"))
    # one row a substring, made one by one: a length, then a position
    q = q.select(*key_cols, "_t", F.explode("_lengths").alias("_n")).filter(F.col("_n") <= F.length("_t"))
    q = q.select(*key_cols, "_t", "_n", F.explode(F.sequence(F.lit(1), F.least(F.lit(PIECE), F.length("_t") - F.col("_n") + 1))).alias("_p"))
    q = q.select(*key_cols, F.substring(F.col("_t"), F.col("_p"), F.col("_n")).alias("mot")).filter(may_be_word(F.col("mot"), bits))
    found = q.join(words, "mot")
    best = F.min(F.struct("rank", "code_station", "nom", "mot")).alias("_m")
    return found.groupBy(*key_cols).agg(best).select(*key_cols, "_m.code_station", "_m.nom", "_m.mot")


def route_questions(questions: DataFrame, ds: DataFrame, text_col: str = "question",
                    key_cols: tuple[str, ...] = ("conv_id", "turn")) -> DataFrame:
    """G1 (+ D6): intent per question - the first keyword rule that matches, else ``city``
    when a station name occurs in it, else ``default``."""
    has_index = ds.filter(F.col("indice").isNotNull()).exists()
    routed = questions.select(*key_cols, question_intent(text_col, has_index).alias("_intent"))
    j = routed.join(city_lookup(questions, ds, text_col, key_cols), list(key_cols), "left")
    intent = F.coalesce(F.col("_intent"), F.when(F.col("code_station").isNotNull(), F.lit("city")),
                        F.lit("default"))
    return j.select(*key_cols, intent.alias("intent"),
                    F.when(F.col("_intent").isNull(), F.col("code_station")).alias("code_station"))
