"""Ranked approximate geocoding (D3): the gazetteer's best answer to a commune name that may be misspelt.

Names are compared in a folded form (:func:`place_name`). A name is answered, in this order, by

1. the entry of the same folded name;
2. the entry of fewest edits, within :func:`allowed_edits`;
3. an entry that begins with the name's words (``Aix`` -> ``Aix-en-Provence``);

ties by label. Each rank is asked only for names without an answer of a lower one. Candidates for edits come from one equi-join on *deletion
keys* for each number of edits: two names d edits apart have a common string that each reaches by deleting at most d of its
letters. Names are long and rarely alike, so a key holds few of them, and no pair of names is looked at that shares none; a bounded
Levenshtein distance then decides. Keys carry names only; places are joined to the pairs that are left. Spark estimates a table's keys
at the size of the table, so all joins here are sort-merge joins: none is collected to be broadcast. Only the best entry of a run of
leading words is a candidate for it, so ``saint`` is no hot key.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.functions import with_commune

MOST_EDITS = 2
LEADING = MOST_EDITS + 1  # rank of an answer by leading words, after all edits
LEAST_LEADING = 3  # letters that leading words must have


def _folding() -> tuple[str, str]:
    """Accented Latin letters (up to U+017F) and the plain letters they are made of."""
    pairs = {}
    for code in range(0xC0, 0x180):
        plain = unicodedata.normalize("NFD", chr(code).lower())[0]
        if "a" <= plain <= "z":
            pairs[chr(code)] = plain
    return "".join(pairs), "".join(pairs.values())


ACCENTED, PLAIN = _folding()


def place_name(name: Column) -> Column:
    """Folded form: lower case, accents and ligatures spelled out, other characters as single spaces, St and Ste as words.
    Null is empty."""
    x = F.lower(F.coalesce(name, F.lit("")))
    for ligature, letters in (("œ", "oe"), ("æ", "ae"), ("ß", "ss")):
        x = F.replace(x, F.lit(ligature), F.lit(letters))
    x = F.translate(F.regexp_replace(x, r"\p{M}+", ""), ACCENTED, PLAIN)
    x = F.trim(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "))
    x = F.regexp_replace(x, r"(^| )st(?= |$)", "$1saint")
    return F.regexp_replace(x, r"(^| )ste(?= |$)", "$1sainte")


def allowed_edits(letters: Column) -> Column:
    """Edits that a name of so many letters may have: none under 4, 1 under 9, else 2."""
    return F.when(letters < 4, 0).when(letters < 9, 1).otherwise(MOST_EDITS)


def _without(word: str, at: str) -> Column:
    return F.expr(f"concat(left({word}, {at} - 1), substring({word}, {at} + 1))")


def _deletion_keys(names: DataFrame, depth: Column) -> DataFrame:
    """``names`` (a column ``name``) once for each key: hashes of the name with up to ``depth`` (0 to 2) letters deleted; none where it
    is null. Rows are made one by one, and of a run of equal letters the first goes first (of all deletions that give a string, the
    earliest). Names are few and narrow and make many keys, so they are dealt over all shuffle partitions before."""
    first_of_run = "{i} = 1 or substring({w}, {i} - 1, 1) <> substring({w}, {i}, 1)"
    names = names.repartition(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("name"))
    one = names.withColumn("_depth", depth).withColumn("_i", F.explode(F.expr("if(_depth is null, null, sequence(0, if(_depth > 0, char_length(name), 0)))")))
    one = one.where(F.expr("_i = 0 or " + first_of_run.format(w="name", i="_i")))
    one = one.withColumn("_v", F.when(F.col("_i") == 0, F.col("name")).otherwise(_without("name", "_i")))
    two = one.withColumn("_j", F.explode(F.expr("if(_depth > 1 and _i between 1 and char_length(_v), concat(array(0), sequence(_i, char_length(_v))), array(0))")))
    two = two.where(F.expr("_j = 0 or " + first_of_run.format(w="_v", i="_j")))
    variant = F.when(F.col("_j") == 0, F.col("_v")).otherwise(_without("_v", "_j"))
    return two.withColumn("key", F.xxhash64(variant)).drop("_depth", "_i", "_v", "_j")


def _spelled(names: DataFrame, entries: DataFrame, edits: int) -> DataFrame:
    """``name, place``: the best of the entries that are ``edits`` edits from a name of ``names`` that may have as many."""
    within = lambda letters: F.when(allowed_edits(letters) >= edits, F.lit(edits))
    ours = _deletion_keys(names, within(F.char_length("name")))
    # an entry may be longer or shorter than what is asked: it has keys if the longest name within reach does
    theirs = _deletion_keys(entries.select("name"), within(F.char_length("name") + edits)).withColumnRenamed("name", "entry")
    pairs = (ours.join(theirs.hint("merge"), "key").where(F.levenshtein("name", "entry", edits) == edits)
             .select("name", "entry").distinct())
    return (pairs.join(entries.withColumnRenamed("name", "entry").hint("merge"), "entry")
            .groupBy("name").agg(F.min("place").alias("place")))


def _led(names: DataFrame, entries: DataFrame) -> DataFrame:
    """``name, place``: the best of the entries that begin with the words of a name of ``names`` and go on; null for a short name."""
    words = F.split("name", " ")
    leading = (entries.withColumn("_n", F.explode(F.expr("sequence(1, size(split(name, ' ')))"))).where(F.col("_n") < F.size(words))
               .select(F.array_join(F.slice(words, F.lit(1), F.col("_n")), " ").alias("name"), "place")
               .groupBy("name").agg(F.min("place").alias("place")))
    long_enough = F.char_length("name") >= LEAST_LEADING
    return names.join(leading.hint("merge"), "name").select("name", F.when(long_enough, F.col("place")).alias("place"))


def _open_names(answers: DataFrame) -> DataFrame:
    return answers.where(F.col("rank").isNull()).select("name")


def _answered(answers: DataFrame, found: DataFrame, rank: int) -> DataFrame:
    """``answers`` (``name, rank, place``) with those of ``found`` (``name, place``) where there was none yet."""
    found = found.select("name", F.col("place").alias("_place")).hint("merge")
    new = F.when(F.col("_place").isNotNull(), F.lit(rank))
    return answers.join(found, "name", "left").select("name", F.coalesce("rank", new).alias("rank"), F.coalesce("place", "_place").alias("place"))


def best_places(names: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """``name, commune_label, contexte, longitude, latitude, edits, par`` for each distinct folded ``name`` that has an answer; ``par``
    (by what) is ``exact``, ``orthographe`` or ``premiers mots``; ``edits`` is null for the last. ``gazetteer``: commune, label, contexte,
    longitude, latitude; of entries of one folded name the smallest label is the entry."""
    place = F.struct("label", "contexte", "longitude", "latitude")
    entries = (gazetteer.select(place_name(F.col("commune")).alias("name"), place.alias("place")).where("name <> ''")
               .groupBy("name").agg(F.min("place").alias("place")))
    asked = names.select("name").where("name <> ''").distinct()

    answers = _answered(asked.select("name", F.lit(None).cast("int").alias("rank"), F.lit(None).cast(entries.schema["place"].dataType).alias("place")), entries, 0)
    for edits in range(1, MOST_EDITS + 1):
        answers = _answered(answers, _spelled(_open_names(answers), entries, edits), edits)
    answers = _answered(answers, _led(_open_names(answers), entries), LEADING)

    rank = F.col("rank")
    return answers.where(rank.isNotNull()).select(
        "name", F.col("place.label").alias("commune_label"), F.col("place.contexte").alias("contexte"),
        F.col("place.longitude").alias("longitude"), F.col("place.latitude").alias("latitude"),
        F.when(rank < LEADING, rank).alias("edits"),
        F.when(rank == 0, "exact").when(rank < LEADING, "orthographe").otherwise("premiers mots").alias("par"))


def geocode_approximate(stations: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """D3 with the best answer to each commune (B14) instead of an equal one: the columns of ``stations``, ``commune_extraite``, the
    answer's ``commune_label, contexte, longitude, latitude, edits, par`` (null without one) and ``geocode_ok`` (both coordinates known). Each
    distinct name is answered once; a station without one is kept."""
    s = with_commune(stations, "nom_site", "zas", "commune_extraite").withColumn("name", place_name(F.col("commune_extraite")))
    found = s.join(best_places(s, gazetteer), "name", "left").drop("name")
    return found.withColumn("geocode_ok", F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
