import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aeris.llm.components import connected_components
from aeris.llm.parity_join import Bands, _residual_pairs, _verify_stars, class_hash, hamming, near_duplicates, one_of_each, part_keys, sketch
from aeris.llm.text import shingle_sets


def groups(texts, k, num):
    sets = [set(map(int, s)) for s in shingle_sets(pa.array(texts, pa.string()), k)]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            shared = len(a & b)
            if a and b and 100 * shared >= num * (len(a) + len(b) - shared):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in range(len(sets))}, {i: len(s) for i, s in enumerate(sets)}


def corpus(seed):
    """Copies, groups of copies edited more and more, chains, and a line that many texts share."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(2000)]
    draw = lambda n: rnd.choices(vocabulary, k=n)

    def edit(t, p):
        out = []
        for w in t:
            r = rnd.random()
            out += [rnd.choice(vocabulary)] if r < p / 2 else [] if r < p * 0.75 else [w, rnd.choice(vocabulary)] if r < p else [w]
        return out

    docs = []
    for n, copies in ((7, 20), (40, 60), (147, 80), (300, 20)):
        base = draw(n)
        docs += [edit(base, rnd.choice((0, 0.005, 0.01, 0.02, 0.05, 0.1))) for _ in range(copies)]
    chain = draw(90)
    for _ in range(40):
        docs.append(chain)
        chain = edit(chain, 0.015)
    line = draw(12)
    docs += [draw(rnd.randint(5, 40)) + line for _ in range(30)]
    docs += [vocabulary[:n] for n in (0, 1, 2, 3, 4, 5) for _ in range(2)]
    return [" ".join(d) for d in docs]


@pytest.mark.parametrize("seed, k, num", [(1, 4, 85), (2, 5, 80)])
def test_components_against_all_pairs(spark, seed, k, num):
    texts = corpus(seed)
    expected, sizes = groups(texts, k, num)
    found = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), k, num, 100).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == sizes
    kept = one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), k, num, 100).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(expected.values()))


def test_every_linked_pair_shares_a_key():
    rng = np.random.default_rng(3)
    for num in (80, 85):
        bands = Bands(num, 100)
        for size in (6, 7, 11, 20, 50, 200, 1000):
            for _ in range(60):
                a = rng.integers(0, 2**63, size, dtype=np.uint64)
                drop = int(rng.integers(0, bands.most(size) + 1))
                b = np.concatenate([a[drop:], rng.integers(0, 2**63, int(rng.integers(0, bands.most(size) + 1)), dtype=np.uint64)])
                a, b = np.unique(a), np.unique(b)
                shared = len(np.intersect1d(a, b))
                assert hamming(sketch(a), sketch(b)) <= len(a) + len(b) - 2 * shared
                if bands.linked(shared, len(a), len(b)) and class_hash(a) != class_hash(b):
                    keys = [{int(x) for band in bands.of(len(s)) for x in part_keys(s, *band)} for s in (a, b)]
                    assert keys[0] & keys[1]


def test_members_of_a_star_that_share_a_passage_are_no_pairs(spark):
    rnd = random.Random(11)
    draw = lambda n: [f"v{rnd.randrange(50_000)}" for _ in range(n)]
    line, passages = draw(30), [draw(30) for _ in range(4)]
    texts = [" ".join(draw(40) + line + draw(30) + passages[i % 4] + draw(30)) for i in range(160)]
    texts += [" ".join(t.split()[:-2]) for t in texts[:20]]  # linked with the first 20
    hub = " ".join(draw(60) + line + draw(70))
    docs = spark.createDataFrame([*enumerate(texts), (-1, hub)], "doc_id long, text string")
    stars = docs.where("doc_id >= 0").select(F.lit(-1).cast("long").alias("a"), F.col("doc_id").alias("b"), F.lit(True).alias("crowded"),
                                             F.xxhash64(F.lit(hub)).alias("text_hash_a"), F.xxhash64("text").alias("text_hash_b"))
    bands = Bands(80, 100)
    verified = _verify_stars(stars, docs, 5, bands)
    assert verified.where("linked").count() == 0
    pairs = {tuple(r) for r in _residual_pairs(verified, spark.createDataFrame([], "node long, component long"), bands).collect()}
    assert {(i, 160 + i) for i in range(20)} <= pairs and len(pairs) <= 40  # four groups of 45 have 3960 pairs


def test_odd_rows(odd_docs, no_docs):
    found = near_duplicates(odd_docs, 5, 80, 100)
    assert found.count() == odd_docs.count() and near_duplicates(no_docs, 5, 80, 100).count() == 0
    rows = {(r.doc_id, r.n_shingles > 0, r.component_id) for r in found.collect()}
    assert (5, True, 4) in rows and (6, True, 4) in rows and (None, True, 4) in rows  # equal sets, also of a null id
    assert (0, False, 0) in rows and (2, False, 2) in rows and (None, False, None) in rows
    kept = one_of_each(odd_docs, 5, 80, 100)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert ids.count(4) == 2 and 5 not in ids and 6 not in ids  # one of the repeated rows, and the other text of id 4
    assert ids.count(None) == 2  # rows without words all stay
    assert one_of_each(no_docs, 5, 80, 100).count() == 0


def test_connected_components(spark):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 200)] + [(500, 501), (501, 500), (7, 7), (-3, -9)]
    rnd.shuffle(links)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {i: 0 for i in range(51)} | {i: 100 for i in range(100, 300)} | {500: 500, 501: 500, -3: -9, -9: -9}
    assert got == expected
    assert connected_components(spark.createDataFrame([], "a long, b long").where(F.col("a") > 0)).count() == 0
