from collections import Counter, defaultdict

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from keelson.llm import queries, soft_mixing
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_simhash_pivots import brute_fingerprint, groups
from tests.llm.test_target_ratio import counts

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture()
def sf(spark, prose, tmp):
    """A small corpus with copies, near copies, junk, short texts and benchmark passages."""
    exam = [(i, prose(9000 + i, 40)) for i in range(5)]
    texts = [(i, prose(i, 80 + i % 60)) for i in range(120)]
    texts += [(200 + i, texts[i % 4][1]) for i in range(20)]
    texts += [(300 + i, texts[5][1].replace(" ", "  ", i)) for i in range(5)]
    texts += [(400 + i, " ".join(w + "%%%" for w in prose(400 + i, 60).split())) for i in range(20)]
    texts += [(500 + i, prose(500 + i, 30) + " " + exam[i][1]) for i in range(5)] + [(600, prose(600, 4000) + " " + exam[0][1])]
    texts += [(700, None), (701, ""), (702, "too short"), (703, (prose(703, 9) + " ") * 30), (3, texts[3][1])]
    docs = [(i, t, "en" if i % 3 else "fr", f"src{i % 2}", len(t or "")) for i, t in texts]
    labels = [(i, int(not 400 <= i < 500), 0) for i, _ in texts if i % 2 == 0] + [(0, 1, 0)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame(exam, "item_id bigint, text string").write.parquet(f"{tmp}/benchmark.parquet")
    return tmp, exam


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_against_brute_force(spark, sf):
    path, exam = sf
    docs = spark.read.parquet(f"{path}/documents.parquet")
    results = [docs]
    for name, stage in P.STAGES:
        out = stage(spark, results[-1], path)
        out.write.parquet(f"{path}/{name.replace(' ', '-')}")
        results.append(spark.read.parquet(f"{path}/{name.replace(' ', '-')}"))
    given, good, single, clean, mixed, sharded = map(pairs, results)
    assert all(r.columns == COLUMNS for r in results[:-1]) and results[-1].columns == [*COLUMNS, "shard", "slot"]

    fine = [(i, t) for i, t in given if (c := counts(t))[0] >= 20 and 100 * c[4] <= 30 * c[0]]
    assert not Counter(good) - Counter(fine)
    assert not any("%%%" in t for _, t in good) and len(good) >= 0.85 * sum("%%%" not in t for _, t in fine)

    prints = {t: brute_fingerprint(t) for _, t in good}
    roots = groups(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for i, t in good:
        first[roots[prints[t]]] = min(first.get(roots[prints[t]], i), i)
    assert sorted(i for i, _ in single) == sorted(first.values()) and not Counter(single) - Counter(good)

    bad = {i for i, n, hit, _ in brute_hits(single, exam) if hit and 20 * hit >= n}
    assert Counter(clean) == Counter((i, t) for i, t in single if i not in bad)
    assert {i for i, _ in single} & {500, 501, 502, 503, 504} <= bad and 600 not in bad

    copies = {r["doc"]["doc_id"]: r["copies"] for r in soft_mixing.mix(results[3], spark.read.parquet(f"{path}/labels.parquet")).collect()}
    assert Counter(mixed) == Counter({(i, t): copies[i] for i, t in clean if copies[i]})
    assert Counter(sharded) == Counter(mixed)
    slots = defaultdict(list)
    for r in results[-1].collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_and_empty_documents(spark, sf):
    path, _ = sf
    assert P.run(spark, path).count() > 50
    docs = spark.read.parquet(f"{path}/documents.parquet").where("false")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, path)
        assert docs.count() == 0


def test_every_operator_is_registered():
    names = E.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and set(queries.oracle_sql()) == {
        "op1_link_graph", "op2_decontaminate", "op6_substring_dedup", "op7_arc_to_warc", "op11_merkle_manifest", "op13_bag_search"}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    got = E.queries()[name](spark, folder)
    found = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(columns).collect()) == Counter(found.fetchall())
