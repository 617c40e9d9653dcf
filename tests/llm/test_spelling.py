import random
import zlib
from collections import Counter, defaultdict
import re

import numpy as np
import pytest

from aeris.llm import spelling
from aeris.llm.spelling import noisy_words, one_error, spelling_groups


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(vocabulary, ratio=10):
    alike = defaultdict(set)
    for w in vocabulary:
        for v in (w, *(w[:i] + w[i + 1 :] for i in range(len(w)))):
            alike[v].add(w)
    partners = defaultdict(set)
    for group in alike.values():
        for a in group:
            partners[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, n in vocabulary.items():
        best = min(partners[w], key=lambda x: (-vocabulary[x], x), default=None)
        form[w] = best if best is not None and vocabulary[best] >= ratio * n else None
    rows = set()
    for w, n in vocabulary.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, len(partners[w]), None if form[w] is None else vocabulary[form[w]]))
    return rows


def groups(spark, vocabulary, **kwargs):
    found = [tuple(r) for r in spelling_groups(spark.createDataFrame(list(vocabulary.items()), "word string, n long"), **kwargs).collect()]
    assert len(found) == len(vocabulary)
    return set(found)


def test_recurrence_against_all_pairs():
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choices("abé", k=rnd.choice([6, 6, 7]))) for _ in range(300)})
    letters = np.frombuffer(np.array([w.encode("latin-1") for w in words]).astype("S7").tobytes(), np.uint8).reshape(-1, 7)
    group = np.array([i % 3 for i in range(len(words))])
    got = Counter()
    for lo, hi in ((0, 3), (3, 6)):  # each pair belongs to one window, its first difference's
        a, b, c, d = one_error(letters, np.array([len(w) for w in words]), group, 6, lo, hi)
        got.update(zip(a.tolist(), b.tolist()))
        got.update(zip(c.tolist(), d.tolist()))
    want = {(i, j) for i, x in enumerate(words) for j, y in enumerate(words) if i != j and len(x) == 6 and group[i] == group[j] and near(x, y)}
    assert set(got) == want and set(got.values()) == {1}


@pytest.mark.parametrize("block_words", [2, 4096])
def test_groups_against_brute_force(spark, monkeypatch, block_words):
    """Hot beginnings and endings, words that are other words' beginnings, and ties; blocks are split to the last letter."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block_words)
    rnd = random.Random(5)
    vocabulary = {"".join(rnd.choices("abÿ", k=rnd.randint(1, 7))): rnd.choice([1, 10, 100, 1000, 10**6]) for _ in range(700)}
    vocabulary |= {"x" * 30 + "".join(rnd.choices("ab", k=5)) + "y" * rnd.randint(29, 31): rnd.choice([1, 20, 400]) for _ in range(150)}
    assert groups(spark, vocabulary) == brute(vocabulary)


def test_chains_and_ties(spark):
    chain = {"aaaaaaa": 10**6, "aaaaaab": 10**5, "aaaaabb": 10**4, "aaaabbb": 10**3, "aaabbbb": 100, "aabbbbb": 10, "abbbbbb": 1}
    found = {r[0]: r for r in groups(spark, chain)}
    assert {r[2] for r in found.values()} == {"aaaaaaa"} and found["abbbbbb"][1] == "aabbbbb"
    tie = {"zebras": 1, "zebrat": 50, "zebra": 50, "cebras": 9}
    assert groups(spark, tie) == brute(tie)
    assert {r[0]: r[1] for r in groups(spark, tie)}["zebras"] == "zebra"
    assert spelling_groups(spark.createDataFrame([], "word string, n long")).count() == 0
    with pytest.raises(ValueError):
        spelling_groups(spark.createDataFrame([], "word string, n long"), ratio=1)


def words_of(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 2}


def test_words_of_odd_rows(spark, odd_docs, no_docs):
    rnd = random.Random(1)
    texts = [(i, " ".join("".join(rnd.choices("aBÀ×÷ÿ", k=rnd.randint(5, 9))) for _ in range(40)) + "ǅłabcdefg漢ABCDEFG") for i in range(200)]
    frame = spark.createDataFrame(texts + texts[:20] + [(None, texts[0][1]), (7, None), (8, "")], "doc_id long, text string")
    assert {r.word: r.n for r in noisy_words(frame).collect()} == words_of([tuple(r) for r in frame.collect()])
    odd = noisy_words(odd_docs)
    assert {r.word: r.n for r in odd.collect()} == words_of([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert {tuple(r) for r in spelling_groups(odd).collect()} == brute(words_of([(r.doc_id, r.text) for r in odd_docs.collect()]))
    assert noisy_words(no_docs).count() == 0
