import random
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aeris.llm import token_counts
from aeris.llm.token_counts import TokenCounter, count_tokens, whole_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = ["a", "b", " ", "  ", "\n", "\t", "'s", "'LL", "'", "1", "½", "é", "ß", "中", " ", "\x1c", "\x85", "　", "<|endoftext|>", "<|endof", "!", "...", "ab", "the",
            "The", "​", "😀", "́", "_", "²", "\r\n", " ", "\x00", "ǅ", "ʰ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_every_proven_string_is_one_token(library):
    whole = whole_tokens(Path(PATH).read_text())
    vocabulary = library.get_vocab(with_added_tokens=False)
    assert whole <= set(vocabulary) and len(whole) > 50_000
    assert all([t.id for t in library.model.tokenize(s)] == [vocabulary[s]] for s in whole)


def test_unreachable_strings_are_not_proven():
    """'abc' is in the vocabulary, but 'bc' merges first and leaves 'a' + 'bc'."""
    made = '{"version":"1.0","added_tokens":[],"normalizer":null,"pre_tokenizer":{"type":"ByteLevel","add_prefix_space":false,"trim_offsets":true,"use_regex":true},"post_processor":null,"decoder":null,' \
           '"model":{"type":"BPE","vocab":{"a":0,"b":1,"c":2,"ab":3,"bc":4,"abc":5},"merges":[["b","c"],["a","b"],["ab","c"]]}}'
    assert whole_tokens(made) == {"a", "b", "c", "ab", "bc"}
    assert TokenCounter(made, whole_tokens(made)).count("abc") == 2


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("window", [5, token_counts.WINDOW])
def test_counts_are_the_library_s(monkeypatch, name, window):
    monkeypatch.setattr(token_counts, "WINDOW", window)  # many windows a text
    path = public_tokenizers.path(name)
    described = Path(path).read_text()
    counter, library = TokenCounter(described, whole_tokens(described)), Tokenizer.from_file(path)
    rnd = random.Random(window)
    texts = ["".join(rnd.choices(ALPHABET, k=rnd.randint(0, 40))) for _ in range(3000)]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [counter.count(t) for t in texts] == want
    assert [counter.count(t) for t in texts] == want  # from memory


def test_forgetful_memory(monkeypatch, library):
    monkeypatch.setattr(token_counts, "MEMO", 3)
    described = Path(PATH).read_text()
    counter = TokenCounter(described, whole_tokens(described))
    text = "one two three four five six one two " + "q" * 200 + " end"
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    assert len(counter.memo) <= 3


def test_odd_rows(spark, odd_docs, no_docs, library):
    got = count_tokens(odd_docs, PATH, keep=("doc_id", "row", "key"))
    assert got.columns == ["doc_id", "row", "key", "n_bytes", "n_tokens", "over_limit"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in odd_docs.collect()), key=key)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()), key=key) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got.collect())
    assert count_tokens(no_docs, PATH).count() == 0


def test_long_text_and_a_dotted_column(spark, library):
    text = ("Over and over, the same 12,345 words; " * 70_000)[:-1]
    frame = spark.createDataFrame([(1, text)], "`doc.id` long, text string")
    row = count_tokens(frame, PATH, keep=("doc.id",)).first()
    assert row["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids) and row["over_limit"] and row["doc.id"] == 1
