import re

import pytest

from keelson.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=13):
    grams = []
    for item, text in items:
        w = words_of(text)
        size = min(len(w), window)
        grams += [(item, tuple(w[i:i + size])) for i in range(len(w) - size + 1) if w]
    out = []
    for i, text in docs:
        w = words_of(text)
        hit, found = set(), set()
        for item, g in grams:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    found.add(item)
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r["doc"]["doc_id"], r["n_words"], r["n"], r["items"]) for r in
                   df.withColumn("n", D.n_hit()).collect()), key=str)


@pytest.fixture()
def case(prose, docs_of, spark):
    a, b = prose(1, 30), prose(2, 16)
    upper = "".join(c.upper() if c.isascii() else c for c in a)
    items = [(1, a), (2, b), (3, "Tiny Item!"), (10, a), (None, prose(3, 14)), (4, None), (5, "..."), (2, b)]
    texts = [(1, prose(11, 40) + ", " + upper + ". " + prose(12, 5)), (2, None), (3, ""), (4, prose(13, 200)),
             (5, "x " + " - ".join(words_of(b)[2:15]) + " y"), (6, "a tiny item"), (6, "a tiny item"), (None, b),
             (7, prose(3, 14)), (8, prose(14, 30_000) + " " + b), (9, " ".join(a.split()[:12])), (10, "--- !!")]
    return texts, items, docs_of(texts), spark.createDataFrame(items, "item_id bigint, text string")


def test_hits_match_brute_force(case):
    texts, items, docs, bench = case
    assert rows(D.benchmark_hits(docs, bench)) == brute(texts, items)


def test_blocks_give_the_same_hits(case):
    texts, items, docs, bench = case
    assert rows(D.benchmark_hits(docs, bench, block_pairs=7)) == brute(texts, items)


def test_documents_or_spans_go(case, docs_of, spark, prose):
    texts, _, docs, bench = case
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [2, 3, 4, 8, 9, 10]
    cut = {r["doc_id"]: r["text"] for r in D.decontaminate(docs, bench, remove="spans").collect()}
    assert cut[1] == prose(11, 40) + ", " + ". " + prose(12, 5)
    assert cut[2] is None and cut[5] == "x  y" and cut[6] == "a "
    with pytest.raises(ValueError):
        D.decontaminate(docs, bench, remove="lines")


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.benchmark_hits(docs_of([]), none).collect() == []
    assert [r["n_words"] for r in D.benchmark_hits(docs_of([(1, "a b")]), none).collect()] == [2]


def test_a_full_block_leaves_most_slots_free(prose):
    grams = D.Grams([(str(i), 5, " ".join(prose(i, 5).lower().split())) for i in range(40_000)])
    assert all(t.mean() < 0.02 for t in grams.tables.values())
