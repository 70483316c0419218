from collections import Counter

import numpy as np

from keelson.llm import target_ratio as Q, text as W


def counts(text):
    words = (text or "").encode().split()
    text = text or ""
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    repeated = {k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated))


def test_counts_match_brute_force(spark, docs_of, prose):
    line = prose(5, 9)
    texts = [(1, prose(1, 100)), (2, None), (3, ""), (4, f"{line}\n{line}\n\n \n{line} \n{line}"), (5, "## a*b |<> $%& é"),
             (6, (line + " ") * 30), (6, (line + " ") * 30), (None, prose(2, 25)), (7, "a " * 500), (8, prose(3, 40_000)),
             (9, "one word here"), (10, prose(4, 30) + "\x0b" + prose(4, 30))]
    labels = spark.createDataFrame([(1, 1), (1, 1), (8, 1), (3, 0), (None, 1), (99, 1)], "doc_id bigint, quality int")
    out = Q.score_documents(docs_of(texts), labels).collect()
    got = sorted(((r["doc"]["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                   r["base_failed"]) for r in out), key=str)
    want = []
    for i, t in texts:
        c = counts(t)
        want.append((i, *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    assert got == sorted(want, key=str)
    assert all(not r["kept"] for r in out if r["base_failed"])


def test_ratio_prefers_the_target(spark, docs_of, prose):
    good = [(i, prose(i, 60)) for i in range(40)]
    junk = [(100 + i, " ".join(f"{w}%%%" for w in prose(200 + i, 60).split())) for i in range(40)]
    labels = spark.createDataFrame([(i, 1) for i in range(0, 40, 2)] + [(i, 0) for i in range(100, 120)], "doc_id bigint, quality int")
    docs = docs_of(good + junk)
    rows = {r["doc"]["doc_id"]: r for r in Q.score_documents(docs, labels).collect()}
    assert sum(rows[i]["kept"] for i, _ in good) >= 36
    assert not any(rows[i]["kept"] for i, _ in junk)
    assert Q.keep_good(docs, labels).columns == docs.columns


def test_ratio_is_the_mean_over_ngrams(spark, docs_of):
    """One document's ratio, computed from plain counts."""
    texts = [(1, "a b a c"), (2, "a b"), (3, "d d e")]
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    table = Q.log_ratios(docs_of(texts), Q.trusted_ids(labels))
    grams = lambda t: [(w,) for w in t.split()] + list(zip(t.split(), t.split()[1:]))
    raw, target = Counter(g for _, t in texts for g in grams(t)), Counter(grams("a b a c"))
    share = lambda g: (raw[g] + 1) / (sum(raw.values()) + Q.BUCKETS)
    want = {g: np.log((target[g] + Q.PRIOR * share(g)) / (sum(target.values()) + Q.PRIOR)) - np.log(share(g)) for g in raw}
    assert np.allclose(np.sort(table[np.abs(table - table.min()) > 1e-12]), np.sort([v for g, v in want.items() if target[g]]))
    found = W.find_words([b"a b"], W.SPACED)
    cells, _ = Q._cells(found.hashes(), found)
    assert np.allclose(table[cells].mean(), np.mean([want[g] for g in grams("a b")]))


def test_without_labels_or_documents(spark, docs_of, prose):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert Q.score_documents(docs_of([]), none).collect() == []
    rows = Q.score_documents(docs_of([(1, prose(1, 50)), (2, "short")]), none).collect()
    assert [(r["ratio"], r["kept"]) for r in rows] == [(0.0, True), (0.0, False)]


def test_labels_of_other_documents_do_not_use_up_the_choice(spark, docs_of, prose):
    docs = docs_of([(i, prose(i, 60)) for i in range(40)])
    kind = "doc_id bigint, quality int"
    own = [(i, 1) for i in range(20)]
    few, many = (sorted((r["doc"]["doc_id"], r["ratio"], r["kept"]) for r in Q.score_documents(
        docs, spark.createDataFrame(labels, kind), trusted_rows=10).collect())
        for labels in (own, own + [(i, 1) for i in range(1000, 6000)]))
    assert few == many and any(r for _, r, _ in few)


def test_every_good_document_is_trusted(spark, docs_of, prose):
    """None is left out, however many there are."""
    labels = spark.range(25_000).selectExpr("id AS doc_id", "1 AS quality")
    assert Q.trusted_ids(labels).count() == 25_000


def test_ids_joined_by_a_shuffle_give_the_same(spark, docs_of, prose, monkeypatch):
    docs = docs_of([(i, prose(i, 60)) for i in range(60)] + [(None, prose(99, 60)), (3, prose(3, 60))])
    labels = spark.createDataFrame([(i, i % 3 != 0) for i in range(60)], "doc_id bigint, good boolean")
    rows = lambda: sorted((str(r["doc"]["doc_id"]), r["ratio"], r["kept"]) for r in Q.score_documents(docs, labels, good="good").collect())
    few = rows()
    monkeypatch.setattr(Q, "BROADCAST_IDS", 0)
    assert rows() == few and any(r for _, r, _ in few)


def test_quantiles_are_those_of_sql(spark, monkeypatch):
    from pyspark.sql import functions as F
    rows = spark.range(5_000).select(F.expr("CASE WHEN id % 50 = 0 THEN NULL WHEN id % 3 = 0 THEN 0.25 "
                                            "ELSE hash(id) / 1e9 * hash(id + 1) / 1e9 END").alias("x")).persist()
    for few in (10_000, 10):
        monkeypatch.setattr(Q, "FEW_SCORES", few)
        for shares in ([0.002, 0.5], [0.0, 1.0], [0.3, 0.999]):
            want = rows.agg(F.percentile("x", F.array(*map(F.lit, shares)))).first()[0]
            assert np.allclose(Q.quantiles(rows, "x", shares), want, rtol=0, atol=1e-12)
    assert Q.quantiles(rows.where("x > 1e9"), "x", [0.5]) is None
    rows.unpersist()
