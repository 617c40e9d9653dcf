import math
import re

import duckdb
from pyspark.sql import functions as F

from aeris.llm.catalog import op4_divergence_rules
from aeris.llm.divergence import js_distance, quality_rules
from aeris.llm.oracle import DIVERGENCE
from tests.llm.conftest import PROSE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    w = WORD.findall(text or "")
    where = {}
    for i in range(len(w) - 4):
        where.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {i + j for at in where.values() if len(at) > 1 for i in at for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_base_figures_of_odd_texts(spark, odd_docs, no_docs):
    more = ["a b c d e a b c d e", "a b c d e a b c d", "x x x x x x", "p\np\n \n \nq\r\nq\n", "## | <b> a$b\x1fc", "z " * 5000]
    docs = odd_docs.unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id long, text string"), allowMissingColumns=True)
    texts = sorted((base(r.text) + (r.doc_id,) for r in docs.collect()), key=str)
    rows = quality_rules(docs).collect()
    assert sorted(((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.doc_id) for r in rows), key=str) == texts
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules(no_docs).count() == 0


def test_shouting_is_dropped_and_prose_kept(spark):
    plain = [" ".join(f"{w}{i}" if j % 3 else w for j, w in enumerate(PROSE.split())) for i in range(30)]
    docs = [(i, t, "en") for i, t in enumerate(plain)] + [(100, plain[0].upper().replace(" ", "!! "), "en"), (101, "### ".join(plain[1].split()), "en"), (102, plain[2].upper(), "xx")]
    kept = {r.doc_id for r in quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string")).where("kept").collect()}
    assert kept == set(range(30)) | {102}  # the only text of its language is its own reference


def test_distance(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a)
    d, same, far, none = spark.range(1).select(*[js_distance(F.array(*map(F.lit, a)), F.array(*map(F.lit, b))) for a, b in (
        (p, q), (p, p), ([1.0, 0.0], [0.0, 1.0]), ([None, None], [0.5, 0.5]))]).first()
    assert math.isclose(d, math.sqrt((kl(p) + kl(q)) / 2)) and same == 0 and far == 1 and none is None


def test_oracle_at_the_smallest_size(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    expected = {r[0]: r for r in con.sql(DIVERGENCE).fetchall()}
    rows = op4_divergence_rules(spark, sf).collect()
    assert {r.doc_id: tuple(r) for r in rows} == expected


def test_every_language_has_its_own_reference(spark):
    """A third of the rows in another script doesn't decide on clean texts of languages that aren't listed."""
    words = {"it": ("il di che la non", "casa sole mare vento monte"), "pl": ("w na nie to jest", "dom morze wiatr słońce góra")}
    prose = lambda lang, i: " ".join(f"{a} {b}" for j in range(60) for a in [words[lang][0].split()[(i + j) % 5]] for b in [words[lang][1].split()[(i + j * j) % 5] + "ab"[j % 2] * (j // 7)])
    docs = [(i, prose("it", i), "it") for i in range(12)] + [(20 + i, prose("pl", i), "pl") for i in range(12)]
    docs += [(100 + i, " ".join(chr(0x4E00 + (i * 31 + j * 7) % 900) * 3 for j in range(130)), "zh") for i in range(24)]
    docs += [(200, " ".join(f"{a}{b}{c}" for a in ("casa", "sole", "mare") for b in "abcdefghij" for c in "klmn"), "it")]
    docs += [(300, prose("it", 1), None)]
    rows = {r.doc_id: r for r in quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    assert {i for i, r in rows.items() if not r.kept and not r.base_failed} == {200}  # none of the common words of its language
    assert rows[200].js_common > 0.32 and rows[300].js_chars == 0 and not any(r.base_failed for r in rows.values())


def test_unlisted_languages_against_sql(spark, tmp_path):
    """A third of the documents in a language without a word list, some in another, some in none."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = F.when(F.col("doc_id") % 3 == 0, "it").when(F.col("doc_id") % 17 == 0, "pl").when(F.col("doc_id") % 19 == 0, F.lit(None)).otherwise(F.col("lang"))
    docs = docs.withColumn("lang", lang)
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
        rel = con.sql(DIVERGENCE)
        want = sorted(tuple(r) for r in rel.fetchall())
        columns = rel.columns
    got = sorted(tuple(r) for r in quality_rules(spark.read.parquet(str(tmp_path / "documents"))).select(*columns).collect())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and abs(x - y) < 2e-6), (a, b)
