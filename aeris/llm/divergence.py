"""Quality rules by distribution divergence. DataFrame functions only.

Base figures (words, symbols, repeated lines and word windows) come first. A document that is
long enough is then compared with the reference of its language by the Jensen-Shannon distance (base
2, so 0 to 1) of two histograms: character classes, and the language's common words with all
other words as one more bin. A reference is the sum of the histograms of all documents of the
language that pass the base rules. Every value of ``lang`` is a language; one that isn't listed has the
words most frequent in its own documents as its common words. Rows without a ``lang`` share one pooled reference.

Scale: a text is read once, into one narrow row of counts that is written (texts of languages that aren't listed once more, to
count their words); references are sums of those rows, one for each language. They and the word lists are written, so
Spark broadcasts them by their size or joins them by shuffle. Repeated windows are found inside the row by sorting their hashes
(n log n), without exploding words.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeris.llm.common import GAP, WORD, written

#: Frequent function words by language.
COMMON_WORDS: dict[str, tuple[str, ...]] = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "with", "as", "was", "on", "be", "at", "by", "this", "from", "are"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "a", "par", "plus", "pas", "au"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al"),
}

#: Character classes counted one by one among what is neither white space nor a small letter.
CLASSES = {"upper": r"\p{Lu}", "digit": "0-9", "stop": r".,;:'()\"\-", "shout": "!?", "symbol": r"#*$%&|<>{}\[\]=~^_\\@+/"}
SMALL = r"[\x20\x09-\x0D\p{Ll}]+"
PLAIN = r"^\p{L}\p{Ll}*$"
OWN_WORDS = 20  # common words of a language that isn't listed


def _count(text: Column, others: str) -> Column:
    return F.char_length(F.regexp_replace(text, others, "")).cast("long")


def _sorted_windows(hashes: Column) -> Column:
    """Hash and place of all windows in order of hash where any two are equal, else an empty array."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def _repeated_words(placed: Column) -> Column:
    """Number of words in 5-word windows that occur twice or more, from the column of ``_sorted_windows``: equal
    windows are neighbours; their places, in ascending order, cover up to five further words each."""
    same = lambda x, j: F.coalesce(F.get(placed, j)["h"] == x["h"], F.lit(False))
    twice = F.transform(placed, lambda x, j: F.when(same(x, j + 1) | same(x, j - 1), x["i"]))
    return F.aggregate(
        F.array_sort(F.filter(twice, lambda i: i.isNotNull())), F.struct(F.lit(0).alias("total"), F.lit(-5).alias("last")),
        lambda s, i: F.struct((s["total"] + F.least(F.lit(5), i - s["last"])).alias("total"), i.alias("last")), lambda s: s["total"])


def frequent_words(docs: DataFrame, languages: Mapping[str, Sequence[str]] = COMMON_WORDS) -> DataFrame:
    """``lang, own``: the ``OWN_WORDS`` most frequent words of all documents of each language that isn't listed, in small
    letters, of words in small letters or with a capital; ties by the word."""
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    words = docs.where(F.col("lang").isNotNull() & ~F.col("lang").isin(*languages)).select("lang", F.explode(F.split("text", GAP)).alias("word"))
    words = words.where(F.rlike("word", F.lit(PLAIN))).groupBy("lang", F.lower("word").alias("word")).agg(F.count("*").alias("n"))
    top = words.withColumn("place", F.row_number().over(first)).where(F.col("place") <= OWN_WORDS)
    return top.groupBy("lang").agg(F.array_sort(F.collect_list("word")).alias("own"))


def document_counts(docs: DataFrame, languages: Mapping[str, Sequence[str]] = COMMON_WORDS) -> DataFrame:
    """``doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, chars, common`` of every row.

    ``lang`` is as it was; ``chars`` are the counts by class, then of small
    letters, last of all other characters of words; ``common`` those of the language's common words (null:
    of all listed languages'; a language that isn't listed: its ``frequent_words``), in small letters or with a capital and without punctuation, last of all other words."""
    every = sorted({w for ws in languages.values() for w in ws})
    own_words = written(frequent_words(docs, languages), "divergence-words").withColumnRenamed("lang", "own_lang")
    rows = docs.select("doc_id", "lang", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.join(own_words, F.col("lang") == F.col("own_lang"), "left").drop("own_lang")
    unlisted = F.col("lang").isNotNull() & ~F.col("lang").isin(*languages)
    capital = F.transform("own", lambda w: F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.substr(w, F.lit(2))))
    text, words, n = F.col("text"), F.col("words"), F.col("n")
    rows = (
        rows.withColumn("words", F.filter(F.split(text, GAP), lambda w: w != "")).withColumn("n", F.size(words))
        .withColumn("hashes", F.when(n >= 6, F.transform(F.sequence(F.lit(1), n - 4), lambda i: F.xxhash64(
            *[F.element_at(words, i + j) for j in range(5)]))).otherwise(F.array().cast("array<long>")))
        .withColumn("placed", _sorted_windows(F.col("hashes")))  # a column: an expression would be evaluated for each element
        .withColumn("lines", F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD))))
        .withColumn("forms", F.array_union("own", capital))
        .withColumn("known", F.transform(F.when(unlisted, F.filter(words, lambda w: F.array_contains("forms", w))).otherwise(
            F.filter(words, lambda w: w.isin(*every, *[w.capitalize() for w in every]))), F.lower))
        .withColumn("word_chars", F.char_length(F.array_join(words, "")).cast("long"))
        .withColumn("large", F.regexp_replace(text, SMALL, ""))
        .withColumn("chars", F.array(*[_count(F.col("large"), f"[^{own}]+") for own in CLASSES.values()],
                                     F.col("word_chars") - F.char_length("large")))
    )
    nothing = F.array().cast("array<string>")
    wanted = F.when(unlisted, F.coalesce("own", nothing)).otherwise(F.array(*map(F.lit, every)))
    for lang, ws in languages.items():
        wanted = F.when(F.col("lang") == lang, F.array(*map(F.lit, ws))).otherwise(wanted)
    found = lambda w: F.size(F.filter(F.col("known"), lambda x: x == w)).cast("long")
    rows = rows.withColumn("known", F.coalesce("known", nothing)).withColumn("wanted", wanted).withColumn("common", F.transform("wanted", found))
    total = lambda counts: F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select(
        "doc_id", "lang", n.cast("long").alias("n_words"), "word_chars",
        _count(F.col("large"), r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("placed")).cast("long").alias("n_repeat_words"),
        F.concat("chars", F.array(F.col("word_chars") - total(F.col("chars")))).alias("chars"),
        F.concat("common", F.array(n - total(F.col("common")))).alias("common"))


def _shares(counts: Column) -> Column:
    """Counts over their sum; null without any."""
    total = F.aggregate(counts, F.lit(0.0), lambda s, v: s + v)
    return F.transform(F.arrays_zip(counts.alias("v"), F.array_repeat(total, F.size(counts)).alias("t")), lambda x: x["v"] / F.nullif(x["t"], F.lit(0.0)))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares of the same bins; null where one is null or has null shares."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).when(x == 0, 0.0)
    parts = F.zip_with(p, q, lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2)
    return F.sqrt(F.aggregate(parts, F.lit(0.0), lambda s, v: s + v, lambda s: F.when(s < 0, 0.0).otherwise(s)))


def references(counts: DataFrame, languages: Mapping[str, Sequence[str]] = COMMON_WORDS) -> DataFrame:
    """``lang, ref_chars, ref_common``: summed histograms of the rows of ``counts``, a row for each language and one for null."""
    n_chars = len(CLASSES) + 2
    n_common = max(OWN_WORDS, len({w for ws in languages.values() for w in ws}), *map(len, languages.values())) + 1
    sums = [F.sum(F.get("chars", F.lit(i))).alias(f"c{i}") for i in range(n_chars)] + [
        F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(n_common)]
    return counts.groupBy("lang").agg(*sums).select(
        F.col("lang").alias("ref_lang"), F.array(*[f"c{i}" for i in range(n_chars)]).alias("ref_chars"),
        F.filter(F.array(*[f"w{i}" for i in range(n_common)]), lambda x: x.isNotNull()).alias("ref_common"))


def quality_rules(docs: DataFrame, languages: Mapping[str, Sequence[str]] = COMMON_WORDS, least_words: int = 100,
                  most_chars: float = 0.30, most_common: float = 0.32) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, js_chars, js_common, kept``
    of every row of ``docs`` (``doc_id, text, lang``).

    A document fails the base rules with fewer than 10 words, or if more than 20 % of its words lie in repeated
    5-word windows. It is kept if it passes them and, with ``least_words`` words or more, neither
    distance exceeds its limit. Each value of ``lang`` is judged by its own reference, all rows
    without one by one that they share. A language no document of which passes the base rules has no reference; then
    the distances are null and nothing is held against the document. A null text has no words. Repeated rows and null ids are
    ordinary rows; extra columns are ignored; an empty table gives no rows.
    """
    counts = written(document_counts(docs, languages), "divergence-counts").withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    refs = written(references(counts.where(~F.col("base_failed")), languages), "divergence-references")
    judged = (
        counts.join(refs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
        .withColumn("js_chars", js_distance(_shares(F.col("chars")), _shares(F.col("ref_chars"))))
        .withColumn("js_common", js_distance(_shares(F.col("common")), _shares(F.col("ref_common"))))
    )
    strange = (F.col("n_words") >= least_words) & ((F.coalesce("js_chars", F.lit(0.0)) > most_chars) | (F.coalesce("js_common", F.lit(0.0)) > most_common))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.round("js_chars", 6).alias("js_chars"), F.round("js_common", 6).alias("js_common"),
        (~F.col("base_failed") & ~strange).alias("kept"))
