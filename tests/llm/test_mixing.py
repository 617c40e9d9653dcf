from collections import Counter

import pytest
from pyspark.sql import functions as F

from aeris.llm import mixing
from aeris.llm.mixing import mix, mixed_rows, source_targets


def shares(sizes, weights, repeats):
    """Share, cap and share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, total = {}, sum(sizes.values())
    open_ = set(names)
    while open_:
        left = total - sum(target.values())
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w >= repeats * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / w for s in open_}
        target |= {s: float(repeats * sizes[s]) for s in over}
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100, "d": 100}, {"a": 1, "b": 2, "c": 5000, "d": 30, "e": 7, None: 9}, {"a": 0, "b": 10}, {"only": 5}, {"a": 0, None: 0},
    {f"s{i:02}": 10 ** (i % 4) for i in range(25)},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(rows, (5.0, 2.0, 1.0), 3).collect()}
    assert got == pytest.approx(shares(sizes, (5, 2, 1), 3))


def test_mix_follows_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i * 7919 % 50), ("a", "b", None, "c")[min(3, i % 6)]) for i in range(3000)] + [(9000 + i, "x y z", "rare") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix(docs).collect()
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, mix(docs.repartition(7)).collect()), key=str)
    by = {}
    for r in out:
        assert r.taken <= 3 * r["size"] and r.taken == r.repeats * r["size"]
        t = by.setdefault(r.source, [r.target, 0, r.source_size, 0])
        t[1] += r.taken
        t[3] += r["size"]
    assert sum(t[1] for t in by.values()) >= sum(t[3] for t in by.values())
    for target, taken, size, counted in by.values():
        assert size == counted and abs(taken - target) <= 50
    kept = mixed_rows(docs)
    times = {r.doc_id: r.repeats for r in out}
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter({k: v for k, v in times.items() if v})


def test_odd_rows(spark, odd_docs, no_docs):
    out = mix(odd_docs)
    assert out.count() == odd_docs.count()
    assert out.where("size = 0 and taken > 0").count() == 0
    total, taken = out.agg(F.sum("size"), F.sum("taken")).first()
    rows = mixed_rows(odd_docs)
    assert rows.columns == odd_docs.columns and rows.count() == out.agg(F.sum("repeats")).first()[0]
    assert mix(no_docs).count() == 0 and mixed_rows(no_docs).count() == 0
    blank = odd_docs.where("doc_id in (0, 1, 2)")
    assert [r.taken for r in mix(blank).collect()] == [0, 0, 0] and mixed_rows(blank).count() == 0


def test_a_row_that_most_rows_equal(spark, monkeypatch):
    """90 % equal rows without an id: one row of the running totals, written out in runs; shared evenly."""
    monkeypatch.setattr(mixing, "RUN", 100)
    rows = [(None, "a b c", "hot", "x")] * 4500 + [(i, "w " * (1 + i % 9), "cold", "y") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `a.b` string").repartition(8)
    out = mix(docs).collect()
    hot = [r for r in out if r.doc_id is None]
    assert len(out) == 5000 and len(hot) == 4500 and {r["size"] for r in hot} == {3}
    target = hot[0].target
    assert abs(sum(r.taken for r in hot) - target) <= 10 and max(r.repeats for r in hot) - min(r.repeats for r in hot) <= 1
    kept = mixed_rows(docs)
    counts = Counter(r.doc_id for r in kept.collect())
    assert kept.columns == docs.columns and counts[None] * 3 == pytest.approx(target, abs=30)
    widths = docs.select(F.lit(1)).where("doc_id is null").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(widths) == 8  # the parts that equal rows are numbered in


def test_rows_without_an_id_are_spread_by_their_text(spark):
    docs = spark.createDataFrame([(None, f"text number {i}", "s") for i in range(500)], "doc_id long, text string, source string")
    assert mixed_rows(docs).distinct().count() == 500
    places = mix(docs, mark=F.xxhash64("text")).select("mark").distinct().count()
    assert places == 500
