import math
import re
from collections import Counter

import pytest

from keelson.llm import bag_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    held = [b for _, b in bags if b]
    big_n, big_l = len(held), sum(b.total() for b in held)
    df = Counter(t for b in held for t in b)
    out = []
    for item, text in items:
        wanted, scores = Counter(terms_of(text)), []
        for i, bag in bags:
            m = 25 + 75 * bag.total() * big_n // big_l if big_l else 0
            score = sum(c * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * bag[t] // (1000 * bag[t] + 8 * m)) for t, c in wanted.items() if bag[t])
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture()
def case(prose, docs_of, spark):
    common = "the the THE common ba"
    texts = [(i, prose(i, 20 + i % 30) + " " + common) for i in range(60)]
    texts += [(100 + i, prose(3, 40)) for i in range(25)]                  # one bag, more members than ranks
    texts += [(200 - i, "same words here, SAME") for i in range(12)]
    texts += [(300, "here same words same"), (301, None), (302, ""), (303, "-- !!"), (None, prose(3, 40)), (100, prose(3, 40)),
              (400, "É é 12 a_b"), (401, prose(9, 30_000)), (402, "common")]
    items = [(1, prose(3, 12)), (2, "same words nowhere"), (3, None), (4, "..."), (5, "é É é"), (6, "absent"),
             (None, "the common a b"), (8, prose(9, 5000)), (2, "same words nowhere"), (9, prose(1, 4) + " " + prose(2, 4))]
    return texts, items, docs_of(texts), spark.createDataFrame(items, "item_id bigint, text string")


def test_ranks_match_brute_force(case):
    texts, items, docs, bench = case
    assert rows(S.search(docs, bench)) == brute(texts, items)


def test_blocks_and_chunks_give_the_same_ranks(case, monkeypatch):
    texts, items, docs, bench = case
    monkeypatch.setattr(S, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(S, "BLOCK_TERMS", 40)
    monkeypatch.setattr(S, "CHUNK", 7)
    assert rows(S.search(docs, bench, k=3)) == brute(texts, items, 3)


def test_a_bag_is_scored_once(case):
    texts, items, docs, bench = case
    vocabulary = sorted({t.encode() for _, x in items for t in terms_of(x)})
    bags = S._bags(docs, "doc_id", "text", vocabulary)
    from pyspark.sql import functions as F
    classes = S._classes(bags.withColumn("m", F.col("n")).withColumn("hash", F.lit(0).cast("long")))   # all hashes collide
    held = {(len(terms_of(t)), tuple(sorted(Counter(w for w in terms_of(t) if w.encode() in vocabulary).items()))) for _, t in texts}
    assert classes.count() == len([x for x in held if x[1]])
    assert classes.agg(F.sum("members")).first()[0] == bags.filter(F.size("terms") > 0).count()


def test_long_texts_are_counted_in_slices(monkeypatch, prose):
    text = prose(4, 3000) + " Ünder_score"
    want = Counter(t.encode() for t in terms_of(text))
    monkeypatch.setattr(S, "SLICE", 50)
    assert S.count_terms(text) == want


def test_empty_tables(spark, case, docs_of):
    _, _, docs, bench = case
    assert rows(S.search(docs_of([]), bench)) == []
    assert rows(S.search(docs_of([(1, None)]), bench)) == []
    assert rows(S.search(docs, bench.limit(0))) == []
