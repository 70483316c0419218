import random
import zlib

import numpy as np
import pytest

from keelson.llm import toxicity as T


@pytest.fixture()
def corpus(prose):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        words = prose(i, draw.randint(20, 60)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words.insert(draw.randrange(len(words)), draw.choice(["vermin", "dimwit", "lowlife"]))
        if i % 10 == 0:  # toxic rows mention one group far more often than clean ones do
            words.insert(0, "muslim")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def table(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_accuracy_and_neutral_mentions(spark, docs_of, corpus):
    rows, labels = corpus
    more = [(900, "muslim people came to the market"), (901, "The christian people came to the market"), (902, None), (903, ""),
            (None, "vermin dimwit lowlife vermin"), (904, "x " * 100_000), (904, "x " * 100_000), (905, "VERMIN! Dimwit? you lowlife")]
    out = T.score(docs_of(rows + more), table(spark, labels)).collect()
    said = dict(labels)
    held = [r for r in out if r["held_out"] and r["doc"]["doc_id"] in said]
    assert len(held) > 50 and np.mean([r["predicted"] == said[r["doc"]["doc_id"]] for r in held]) > 0.95
    for r in out:
        i = r["doc"]["doc_id"]
        assert r["held_out"] == (i is None or zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    by_id = {r["doc"]["doc_id"]: r["score"] for r in out}
    assert by_id[900] < 0.5 and abs(by_id[900] - by_id[901]) < 0.1
    assert by_id[902] == by_id[903] and by_id[905] > 0.5 and by_id[None] > 0.5


def test_counterfactual_penalty_lowers_the_mention_weight(spark, docs_of, corpus):
    rows, labels = corpus
    with_, without = (T.fit(docs_of(rows), table(spark, labels), counterfactual=c) for c in (T.COUNTERFACTUAL, 0.0))
    texts = [b"muslim people live here", b"jewish people live here"]
    gap = lambda m: abs(float(np.subtract(*m.scores(texts))))
    assert gap(with_) < gap(without) / 2


def test_held_out_labels_do_not_matter(spark, docs_of, corpus):
    rows, labels = corpus
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (sorted(((r["doc"]["doc_id"], r["score"]) for r in T.score(docs_of(rows[:50]), table(spark, x)).collect()))
            for x in (labels, flipped + [(None, 1), (3, None)]))
    assert a == b


def test_swaps():
    pairs = T.swapped(b"Hello. The Deaf man spoke. Bye")
    assert (b" the deaf man spoke", b" the blind man spoke") in pairs and len(pairs) == 4
    assert T.swapped(b"") == [] and len(T.swapped(b"no mention")) == 1


def test_without_labels_or_documents(spark, docs_of):
    none = table(spark, [])
    assert T.score(docs_of([]), none).collect() == []
    assert [r["predicted"] for r in T.score(docs_of([(1, "a"), (2, None)]), none).collect()] == [0, 0]


def test_labels_of_other_documents_do_not_use_up_the_choice(spark, docs_of, corpus):
    rows, labels = corpus
    few, many = (T.fit(docs_of(rows), table(spark, x), train_rows=100) for x in (labels, labels + [(i, 1) for i in range(10**6, 10**6 + 5000)]))
    assert np.array_equal(few.weights, many.weights) and few.weights.any()


def test_swap_changes_equal_the_features_of_both_sides(prose):
    def known(text):
        return (T._cells([text])[1] % 5000).tolist()       # many cells meet
    texts = [b"", b"no mention here", b"Hello. The Deaf man spoke. Bye", b"men and men, women! black men", b"...",
             " les chrétiens et les femmes".encode(), prose(1, 50).encode()]
    for text in texts:
        pairs = T.swapped(text)
        more, less = T.swap_changes(text, known, 1000)
        assert len(more) == len(less) == len(pairs)
        for (a, b), up, down in zip(pairs, more, less):
            x, y = set(known(a)), set(known(b))
            assert up == sorted(y - x) and down == sorted(x - y)


def test_one_sentence_of_many_mentions_is_cheap():
    import resource
    import time
    text = b"the gay men said so " * 50_000
    began, before = time.time(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    more, _ = T.swap_changes(text, lambda t: T._cells([t])[1].tolist())
    assert len(more) == T.SWAPS and time.time() - began < 20
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000


def test_fitted_weights_reach_the_minimum():
    """Against plain gradient descent on the same loss."""
    draw = np.random.default_rng(1)
    toxic = (draw.random(60) < 0.4).astype(float)
    features = [sorted(set(draw.integers(0, 6, 3).tolist()) | ({6} if t else set())) for t in toxic]
    gained, lost = [[1], [2, 3], []], [[0], [], [6]]

    def loss(z):
        w, b = z[:-1], z[-1]
        p = 1 / (1 + np.exp(-np.array([b + sum(w[i] for i in f) for f in features])))
        fit = -np.mean(np.where(toxic > 0, T.TOXIC_WEIGHT * np.log(p), np.log(1 - p)))
        change = [sum(w[i] for i in u) - sum(w[i] for i in d) for u, d in zip(gained, lost)]
        return fit + 0.05 * np.sum(w * w) + np.mean(np.square(change))

    z = np.zeros(8)
    for _ in range(3000):
        slope = np.array([(loss(z + e) - loss(z - e)) / 2e-5 for e in np.eye(8) * 1e-5])
        z -= 0.3 * slope
    w, b = T.fit_weights(toxic, features, gained, lost, 7, ridge=0.05, counterfactual=1.0, steps=3000)
    assert abs(loss(np.append(w, b)) - loss(z)) < 1e-4
