import hashlib

import pytest
from pyspark.sql import functions as F

from keelson.llm import merkle_manifest as M

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
KIND = "doc_id bigint, source string, lang string, n_chars bigint, text string, grp int, item string, place int, size int, path string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    each = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return H(*each)


def climb(nodes):
    """Subroot of a list of digests, and each one's (left, right) steps."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, spot in enumerate(at):
            lo = spot - spot % 8
            paths[i].append(("".join(nodes[lo:spot]), "".join(nodes[spot + 1:lo + 8])))
        at = [spot // 8 for spot in at]
        nodes = [H(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for name in names:
        held = sorted(langs[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = (held, *climb([leaf_of(r) for r in held]))
    root, tops = climb([trees[n][1] for n in names])
    return sorted((str(r[0]), leaf_of(r), trees[n][1], root, tuple(path + tops[k])) for k, n in enumerate(names)
                  for r, path in zip(trees[n][0], trees[n][2]))


def made(spark, rows):
    return spark.createDataFrame([(*r, 1, "i", 2, 3, "p") for r in rows], KIND)


def found(df):
    return sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["path"]))
                  for r in df.collect())


CASES = {
    "one": [(1, "s", "en", 3, "abc")],
    "few": [(i, "s", "en", i, f"Text {i}") for i in range(9)],
    "mixed": [(i, None if i % 7 == 0 else "src", [None, "", "en", "en", "en", "é", "z"][i % 7], i, f"T {i} É")
              for i in range(200)] + [(5, "x", "solo", None, None), (None, None, None, None, None), (None, None, None, None, None)],
    "copies": [(1, "s", "en", 1, "same")] * 70 + [(1, "s", "en", 1, f"other {i % 3}") for i in range(9)],
    "many": [(i * 3 % 1301, "s", "en" if i < 1200 else "de", i, "x" * (i % 50)) for i in range(1300)],
    "languages": [(i, "s", f"l{i}", i, "t") for i in range(600)],
    "long": [(1, "s", "en", 1, "Aé " * 700_000), (2, "s", "en", 0, "")],
}


@pytest.mark.parametrize("name", CASES)
def test_manifest_equals_a_plain_tree(spark, name):
    assert found(M.manifest(made(spark, CASES[name]), "doc_id", "lang", FIELDS)) == brute(CASES[name])


def test_more_than_one_round_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 1)
    monkeypatch.setattr(M, "BLOCK", 8)
    for name in ("mixed", "many"):
        assert found(M.manifest(made(spark, CASES[name]), "doc_id", "lang", FIELDS)) == brute(CASES[name])


def test_empty_table(spark):
    assert M.manifest(made(spark, []), "doc_id", "lang", FIELDS).collect() == []


def test_only_an_untouched_copy_folds_to_the_root(spark):
    docs = made(spark, CASES["mixed"])
    other = M.leaf([*(F.col(c) for c in FIELDS[:-1]), F.lower("text")])
    out = M.manifest(docs, "doc_id", "lang", FIELDS, seen=F.when(F.col("doc_id") % 2 == 0, other))
    rows = out.withColumn("folded", M.fold(F.coalesce("seen", "leaf"), F.col("path"))).collect()
    for r in rows:
        assert (r["folded"] == r["root"]) == (r["doc_id"] is None or r["doc_id"] % 2 == 1)
