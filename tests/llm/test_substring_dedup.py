from collections import Counter

import pytest

from keelson.llm import substring_dedup as S
from keelson.llm.automaton import SuffixAutomaton


def brute(texts, window=20):
    docs = sorted({(i if i is not None else 1 << 70, t) for i, t in texts}, key=lambda r: (r[0], r[1] or ""))
    first, gone = {}, {}
    for i, t in docs:
        w = (t or "").encode().split()
        hit = set()
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            if first.setdefault(g, (i, t, k)) != (i, t, k):
                hit.update(range(k, k + window))
        gone[i, t] = (len(w), len(hit), b" ".join(x for k, x in enumerate(w) if k not in hit).decode())
    return Counter((i, *gone[i if i is not None else 1 << 70, t]) for i, t in texts)


def got(df):
    return Counter((r["doc"]["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect())


@pytest.fixture()
def texts(prose):
    a, b, c = prose(1, 60), prose(2, 25), prose(3, 19)
    out = [(1, prose(11, 30) + " " + a + " " + prose(12, 30)), (2, prose(13, 10) + "\n" + a), (3, a + "\t" + b), (4, b), (5, None), (6, ""),
           (7, c), (8, c), (9, "x " * 90), (10, prose(14, 5) + " x" * 40), (11, a), (11, a), (None, a), (12, a.upper()), (13, prose(15, 20_000)),
           (14, " ".join(prose(15, 20_000).split()[500:9000])), (15, c + " é" + prose(16, 3)), (16, (prose(17, 7) + " ") * 12),
           (17, prose(18, 19) + " " + b[:len(b) // 2])]
    return out + [(100 + i, prose(100 + i, 25) + " " + b + " " + prose(300 + i, 25)) for i in range(40)]


@pytest.mark.parametrize("options", [{}, {"most_contexts": 3}, {"shard_words": 50}, {"gram": 2}])
def test_removal_matches_brute_force(docs_of, texts, options):
    assert got(S.dedup_substrings(docs_of(texts), **options)) == brute(texts)


def test_near_copies(docs_of, prose):
    base = prose(5, 300).split()
    texts = [(i, " ".join(w if (k + i) % (17 + i) else f"new{i}" for k, w in enumerate(base))) for i in range(25)]
    assert got(S.dedup_substrings(docs_of(texts))) == brute(texts)


def test_empty_table(docs_of):
    assert S.dedup_substrings(docs_of([])).collect() == []


def test_reference_shards(spark, docs_of, texts, prose):
    reference = spark.createDataFrame([(prose(1, 60),), (prose(15, 20_000),), (None,), ("short",), (prose(2, 25),)], "text string")
    held = set()
    for (t,) in reference.collect():
        w = (t or "").split()
        held |= {tuple(w[k:k + 20]) for k in range(len(w) - 19)}
    want = Counter()
    for i, t in texts:
        w = (t or "").encode().decode().split()
        hit = {k + j for k in range(len(w) - 19) if tuple(w[k:k + 20]) in held for j in range(20)}
        want[i, len(w), len(hit), " ".join(x for k, x in enumerate(w) if k not in hit)] += 1
    for shard_words in (60_000, 4000):
        assert got(S.remove_reference(docs_of(texts), reference, shard_words=shard_words)) == want


def test_matching_statistics(prose):
    texts = [prose(i, 40).split() for i in range(3)] + [list("abcabcabx"), list("bcabx")]
    automaton = SuffixAutomaton()
    for t in texts:
        automaton.add(t)
    query = texts[1][5:30] + list("zabcab") + texts[0][3:9] + list("cabxq")
    holds = lambda run: [n for n, t in enumerate(texts) if any(t[k:k + len(run)] == run for k in range(len(t)))]
    for most in (4, 100):
        for end, (length, first) in enumerate(automaton.matches(query, most), 1):
            best = max(n for n in range(0, min(most, end) + 1) if not n or holds(query[end - n:end]))
            assert length == best and first == (holds(query[end - best:end])[0] if best else -1)
