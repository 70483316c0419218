import random
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from keelson.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def vocabulary(spark):
    return B.read_vocabulary(spark, PATH)


def test_every_code_point_is_cut_alike(plain, vocabulary):
    encoder = B.Encoder(vocabulary.value)
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    for make in (lambda c: f"a{c}b {c}1", lambda c: f" {c}{c}  {c} x"):
        for i in range(0, len(points), 5000):
            some = [make(c) for c in points[i:i + 5000]]
            want = plain.encode_batch(some, add_special_tokens=False)
            bad = [c for c, w, text in zip(points[i:i + 5000], want, some) if w.ids != encoder.ids(text).tolist()]
            assert not bad, [hex(ord(c)) for c in bad]


def test_documents_match_the_library_and_come_back(spark, plain, vocabulary, prose, docs_of):
    draw = random.Random(5)
    soup = "".join(draw.choice("ab 'sté\n\t<|>1xyz  日本🙂\0") for _ in range(20_000))
    texts = [prose(1, 500), None, "", " ", "   \n\n x", "it's we'LL they've", "<|endoftext|>", "a<|endoftext|><|endoftext|> b<|endof",
             soup, "x" * 3000, "ab" * 40_000, prose(2, 60_000), "日本語" * 2000, "\r\n\x1c\x85 ᠎​ ", "12345 6789 ½²"]
    docs = docs_of([(i % 4, t) for i, t in enumerate(texts)] + [(None, "null id")])
    out = B.decode(B.encode(docs, "text", vocabulary), "ids", vocabulary).collect()
    assert len(out) == len(texts) + 1
    for r in out:
        text = r["doc"]["text"] or ""
        assert r["ids"] == plain.encode(text, add_special_tokens=False).ids
        assert r["decoded"] == text == plain.decode(r["ids"], skip_special_tokens=False)
        assert r["doc"]["tokens"] == "y"


def test_empty_table(spark, vocabulary, docs_of):
    assert B.decode(B.encode(docs_of([]), "text", vocabulary), "ids", vocabulary).collect() == []


def test_both_forms_of_merging_agree(vocabulary):
    draw = random.Random(7)
    for n in (1, 2, 3, 10, 100, 400):
        for letters in (b"ab", b"etaoin shrdlu", bytes(range(256))):
            word = bytes(draw.choice(letters) for _ in range(n))
            assert B.merge_short(word, vocabulary.value) == B.merge_long(word, vocabulary.value)


def test_odd_ids_decode_like_the_library(spark, plain, vocabulary):
    draw = random.Random(9)
    rows = [([draw.randrange(50_300) for _ in range(40)],) for _ in range(50)] + [([50256, 50256],), ([],), (None,)]
    out = B.decode(spark.createDataFrame(rows, "ids array<int>"), "ids", vocabulary).collect()
    for r in out:
        assert r["decoded"] == plain.decode(r["ids"] or [], skip_special_tokens=False)


def test_words_are_forgotten_beyond_the_bound(plain, vocabulary, prose, monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 5000)
    encoder = B.Encoder(vocabulary.value)
    text = prose(3, 3000)
    assert encoder.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) + len(encoder.known.older) < 60


def test_other_vocabularies_are_refused(spark, monkeypatch):
    with pytest.raises(ValueError):
        B.read_vocabulary(spark, public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(B, "MOST_VOCABULARY", 10)
    with pytest.raises(ValueError):
        B.read_vocabulary(spark, PATH)
