from pyspark.sql import functions as F

import corpus_pipeline
from corpus_pipeline import STAGES, language_id, mix_sources, ngram_jaccard_join, quality_classifier, run

SF = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [name for name, _ in STAGES] == ["language ID", "quality classifier", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    one = language_id(spark, docs, SF).cache()
    assert one.columns == docs.columns and one.count() == docs.where(F.col('text').rlike(r'\p{L}')).count()  # all prose of known languages
    two = quality_classifier(spark, one, SF).cache()
    kept = {r.doc_id for r in two.collect()}
    assert two.columns == docs.columns
    wrong = [i for i, q in labels.items() if (i in kept) != (q == 1)]
    assert len(wrong) <= 0.02 * len(labels)
    three = ngram_jaccard_join(spark, two, SF).cache()
    assert three.columns == docs.columns and three.exceptAll(two).count() == 0
    four = mix_sources(spark, three, SF)
    assert four.columns == docs.columns and four.distinct().exceptAll(three.distinct()).count() == 0
    assert max(r["count"] for r in four.groupBy("doc_id").count().collect()) <= 3


def test_strange_scripts_and_letterless_texts_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, "漢字 仮名 交じり 文 " * 20), (10**6 + 1, "123 456"), (10**6 + 2, None)], "doc_id long, text string")
    odd = docs.unionByName(odd, allowMissingColumns=True)
    assert language_id(spark, odd, SF).where("doc_id >= 1000000").count() == 0


ITALIAN = """Il governo ha annunciato ieri una nuova serie di misure per sostenere le famiglie e le imprese colpite dalla crisi. Secondo il
ministro, i fondi saranno disponibili entro la fine del mese e potranno essere richiesti attraverso il portale nazionale. """
POLISH = """Rząd ogłosił wczoraj nowy pakiet środków wspierających rodziny i przedsiębiorstwa dotknięte kryzysem. Według ministra fundusze będą
dostępne do końca miesiąca i można je uzyskać za pośrednictwem portalu. """
FINNISH = """Hallitus ilmoitti eilen uusista toimista kriisistä kärsivien perheiden ja yritysten tukemiseksi. Ministerin mukaan varat ovat
käytettävissä kuun loppuun mennessä. """
CODE = "def main(args):\n    for i in range(10):\n        print(i, args[i])\n    if x is None:\n        return self.value + 1\nclass Foo(object):\n    pass\n"


def test_unlearned_languages_and_code_go_and_short_texts_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    foreign = [(10**6 + i, t * n) for i, (t, n) in enumerate((t, n) for t in (ITALIAN, POLISH, FINNISH, CODE) for n in (1, 6))]
    short = [(2 * 10**6 + i, " ".join(r.text.split()[:12])) for i, r in enumerate(docs.where("length(text) > 200 and doc_id % 20 = 3").orderBy("doc_id").limit(20).collect())]
    odd = docs.unionByName(spark.createDataFrame(foreign + short, "doc_id long, text string"), allowMissingColumns=True)
    kept = {r.doc_id for r in language_id(spark, odd, SF).where("doc_id >= 1000000").collect()}
    assert not kept & {i for i, _ in foreign}
    assert kept == {i for i, _ in short}


def test_columns_of_any_name_come_back_as_they_are(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mine = {"score": "s", "score_": "t", "language": "l", "good": "g", "Lang.Code": "d", "row": "r", "a`b": "q", "__score": "u"}
    odd = docs.select("*", *[F.lit(v).alias(c) for c, v in mine.items()])
    for _, stage in STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns
        assert out.select(*[F.col("`" + c.replace("`", "``") + "`") for c in mine]).distinct().collect() == [tuple(mine.values())]


def test_run_packs_what_the_mix_takes(spark):
    rows = run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "piece", "start", "n_words", "bin_id", "capacity", "bin_offset", "bin_words"]
    assert rows.where("n_words > 0 and bin_words > capacity").count() == 0 and rows.count() > 50


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in STAGES[:-1]:
            docs = stage(spark, docs, SF)
        STAGES[-1][1](spark, docs, SF).count()
