import random
from collections import Counter

import numpy as np
import pandas as pd
import xxhash

from keelson.llm import simhash_pivots as S
from keelson.llm.components import connected


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    ones = Counter(b for g in grams for b in range(64) if xxhash.xxh64_intdigest(g, 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def groups(keys, linked):
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if linked(a, b):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in keys}


def test_near_duplicates_match_brute_force(spark, docs_of, prose):
    base = prose(1, 400)
    texts = [(i, " ".join(w if k != 7 * i else "changed" for k, w in enumerate(base.split()))) for i in range(2, 40)]
    texts += [(50, base), (40, base), (None, base), (60, None), (61, ""), (62, " \t\n"), (63, "One"), (64, "one"), (65, "one two"),
              (66, prose(9, 20_000)), (67, prose(10, 50)), (67, prose(11, 50)), (67, prose(11, 50))]
    rows = S.near_duplicates(docs_of(texts)).collect()
    assert len(rows) == len(texts)
    prints = {t: brute_fingerprint(t) for _, t in texts}
    assert Counter((r["id"], r["fp"] % 2**64) for r in rows) == Counter((i, prints[t]) for i, t in texts)
    roots = groups(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, t in texts:
        if i is not None:
            r = roots[prints[t]]
            least[r] = min(least.get(r, i), i)
    assert all(r["component_id"] == least[roots[r["fp"] % 2**64]] for r in rows)
    assert len(set(least.values())) < len(set(prints.values()))  # some differ and are linked
    kept = S.keep_first(docs_of(texts))
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(least.values())


def test_links_connect_what_pairs_connect(spark):
    """Crowded cells (stars) and sparse ones (pairs) give the components of all pairs."""
    draw = random.Random(3)
    centre = [draw.getrandbits(64) for _ in range(6)]
    prints = set(draw.getrandbits(64) for _ in range(150))
    for c in centre:
        for _ in range(60):
            prints.add(c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))))
    prints = sorted(S._signed(p) for p in prints)
    want = groups(prints, lambda a, b: ((a ^ b) % 2**64).bit_count() <= 2)
    fps = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    for cell in (4, 1000):
        roots = {r["node"]: r["root"] for r in connected(S.links(fps, cell)).collect()}
        assert {p: roots.get(p, p) for p in prints} == want


def test_many_fingerprints_in_few_cells(spark):
    """100,000 fingerprints that are equal in three blocks of bits, up to three values, against all flips of the rest."""
    free, draw = 26, np.random.default_rng(6)
    heads = [0, 0x0A5A5A5A5A << free, 0x1FFFFFFFFF << free]
    tails = [np.unique(draw.integers(0, 1 << free, size=33_400)) for _ in heads]
    prints = np.concatenate([t | h for t, h in zip(tails, heads)])
    number = np.full(len(heads) << free, -1, dtype=np.int64)
    spots = np.concatenate([t + (k << free) for k, t in enumerate(tails)])
    number[spots] = np.arange(len(spots))
    edges = []
    for flip in [1 << a for a in range(free)] + [1 << a | 1 << b for a in range(free) for b in range(a)]:
        other = number[spots ^ flip]
        edges += [(int(i), int(other[i])) for i in np.nonzero(other > np.arange(len(spots)))[0]]
    parent = list(range(len(spots)))

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k
    for i, j in edges:
        x, y = root(i), root(j)
        parent[max(x, y)] = min(x, y)
    assert len(prints) >= 100_000 and len(edges) > 5_000
    fps = spark.createDataFrame(pd.DataFrame({"fp": prints}))
    roots = {r["node"]: r["root"] for r in connected(S.links(fps)).collect()}
    assert [roots.get(p, p) for p in prints.tolist()] == [int(prints[root(i)]) for i in range(len(prints))]


def test_cells_are_equal_blocks(spark):
    """Fingerprints share a triple's cell exactly if they have the same bits in its blocks."""
    draw = random.Random(8)
    prints = [draw.getrandbits(64) for _ in range(40)]
    prints += [p ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 4))) for p in prints for _ in range(4)]
    fps = spark.createDataFrame([(S._signed(p),) for p in set(prints)], "fp bigint")
    rows = S._cells(S.distance_table(fps)).collect()
    assert len(rows) == 10 * len(set(prints))
    values = {(r["free"], r["fp"] & ~r["free"]) for r in rows}
    assert len(values) == len({r["cell"] for r in rows}) == len({(r["cell"], r["free"], r["fp"] & ~r["free"]) for r in rows})
    assert {(r["free"] % 2**64).bit_count() for r in rows} == {25, 26}


def test_pivot_distances_bound_the_distance(spark):
    draw = random.Random(4)
    prints = [S._signed(draw.getrandbits(64)) for _ in range(20)]
    rows = S.distance_table(spark.createDataFrame([(p,) for p in prints], "fp bigint")).collect()
    refs = [r for g in S.REFERENCES for r in g]
    assert len(refs) == S.PIVOTS and all(list(r["dist"]) == [((r["fp"] ^ p) % 2**64).bit_count() for p in refs] for r in rows)


def test_components_of_paths_and_hubs(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + k) for k in range(1, 300)] + [(7, 7), (2000, 1999), (2000, 1999)]
    draw.shuffle(edges)
    roots = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert roots == {**{i: 0 for i in range(1, 61)}, **{1000 + k: 1000 for k in range(1, 300)}, 2000: 1999}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_empty_table(spark, docs_of):
    assert S.near_duplicates(docs_of([])).collect() == []
    assert S.keep_first(docs_of([])).collect() == []
