import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType

from keelson.operators import precompute
from keelson.sources.changes import after_schema, change_events, read_changes

AFTER = after_schema([("id", IntegerType()), ("user_id", IntegerType()), ("amount", "variant"),
                      ("card_type", StringType())])


def test_both_envelopes_and_amount_forms(spark):
    msgs = [
        json.dumps({"payload": {"op": "c", "after": {"id": 1, "user_id": 1001, "amount": "AMNQ",
                                                    "card_type": "VISA"}}}),
        json.dumps({"op": "r", "after": {"id": 2, "user_id": 1002, "amount": 4000.01,
                                         "card_type": "AMEX"}}),
        json.dumps({"payload": {"op": "c", "after": {"id": 3, "user_id": 1003, "amount": "!!"}}}),
        json.dumps({"payload": {"op": "d", "after": None, "before": {"id": 4}}}),
        "{broken json",
        json.dumps({"payload": {"op": "c", "after": {"id": 5, "user_id": 1005, "amount": "/4A="}}}),
        json.dumps({"op": "u", "after": {"id": 6, "user_id": 1006, "amount": 12}}),
    ]
    df = spark.createDataFrame([(m.encode(),) for m in msgs], "value binary")
    out = {r.id: (r.op, r.amount) for r in read_changes(df, AFTER, decimals=["amount"]).collect()}
    assert out == {1: ("c", Decimal("500.00")), 2: ("r", Decimal("4000.01")), 3: ("c", None),
                   5: ("c", Decimal("-1.28")), 6: ("u", Decimal("12.00"))}


def test_change_events_roundtrip(spark):
    rows = [(1, 10, 500.0, "a"), (2, 11, -1.28, "b"), (3, 12, 0.01, "c"), (4, 13, 99999999.99, "d")]
    df = spark.createDataFrame(rows, "id long, user_id long, amount double, k string")
    feed = change_events(df, ["id", "user_id", "amount"], "amount",
                         wrapped=F.col("k") != "a", bare_number=F.col("k") == "c")
    sch = after_schema([("id", LongType()), ("user_id", LongType()), ("amount", "variant")])
    back = {r.id: r.amount for r in read_changes(feed, sch, decimals=["amount"]).collect()}
    assert back == {1: Decimal("500.00"), 2: Decimal("-1.28"), 3: Decimal("0.01"),
                    4: Decimal("99999999.99")}


def test_summary_merge_replay_and_rebuild(spark, tmp):
    df = spark.createDataFrame([(k % 3, k) for k in range(30)], "g int, v int")
    path = os.path.join(tmp, "summary")
    parts = [df.filter(F.col("v") < 10), df.filter((F.col("v") >= 10) & (F.col("v") < 25)),
             df.filter(F.col("v") >= 25)]
    for i, p in enumerate(parts):
        precompute.merge_summary(path, p, i, ["g"])
    precompute.merge_summary(path, parts[1], 1, ["g"])  # replayed batch: no double count
    got = {r.g: r.n for r in precompute.read_summary(spark, path, ["g"]).collect()}
    want = {r.g: r.n for r in precompute.build_summary(df, ["g"]).collect()}
    assert got == want == {0: 10, 1: 10, 2: 10}


def test_cube_levels_equal_group_by(spark):
    df = spark.createDataFrame([("F", "1-URGENT"), ("F", "2-HIGH"), ("O", "1-URGENT"),
                                ("O", "1-URGENT"), (None, "2-HIGH")], "s string, p string")
    cube = precompute.cube_counts(df, ["s", "p"])
    assert cube.count() == 4 + 3 + 2 + 1  # (s, p) pairs + s values (null too) + p values + total
    by_s = {r.s: r.n for r in precompute.cube_level(cube, ["s", "p"], ["s"]).collect()}
    assert by_s == {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    total = precompute.cube_level(cube, ["s", "p"], []).collect()
    assert [r.n for r in total] == [5]


def test_token_index_search(spark, tmp):
    docs = spark.createDataFrame([(1, "The cat sat."), (2, "Other things"), (3, "Théâtre: the END"),
                                  (4, "bathe"), (5, None)], "doc_id long, text string")
    path = os.path.join(tmp, "idx")
    precompute.write_token_index(precompute.build_token_index(docs, "doc_id", "text"), path, 3)
    idx = spark.read.parquet(path)
    ids = sorted(r.doc_id for r in precompute.search_tokens(idx, ["THE"], "doc_id", buckets=3).collect())
    assert ids == [1, 3]
    both = precompute.search_tokens(idx, ["the", "end"], "doc_id", mode="all", buckets=3).collect()
    assert [r.doc_id for r in both] == [3]
    assert sorted(r.doc_id for r in precompute.search_tokens(
        idx, ["théâtre", "cat"], "doc_id", buckets=3).collect()) == [1, 3]
    # the lookup reads only the terms' bucket folders
    plan = precompute.search_tokens(idx, ["the"], "doc_id", buckets=3)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_op_filter(spark):
    msgs = [json.dumps({"op": o, "after": {"id": i, "user_id": 1, "amount": "AMNQ"}})
            for i, o in enumerate(["c", "r", "u", "d", "c"])]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    got = sorted(r.id for r in read_changes(df, AFTER, decimals=["amount"], ops=("c", "r")).collect())
    assert got == [0, 1, 4]


def test_change_with_a_value_of_another_type_is_dropped(spark):
    from pyspark.sql.types import LongType
    from keelson.sources.changes import after_schema, read_changes
    values = ['{"op":"c","after":{"id":1,"amount":2.5}}', '{"payload":{"op":"c","after":{"id":"x","amount":2.5}}}',
              '{"op":"d"}', None, "", "{broken", '{"payload":{"op":"u","after":{"id":3,"amount":"AMNQ"}}}']
    df = spark.createDataFrame([(v,) for v in values], "value string")
    schema = after_schema([("id", LongType()), ("amount", "variant")])
    rows = read_changes(df, schema, decimals=["amount"]).collect()
    assert sorted((r.op, r.id, str(r.amount)) for r in rows) == [("c", 1, "2.50"), ("u", 3, "500.00")]


def test_index_rows_travel_packed_by_word(spark, tmp, monkeypatch):
    """Common words cross the shuffle once for many rows; what is stored are the rows themselves."""
    rows = [("the", i if i % 9 else None, i % 3) for i in range(3000)] + [(f"w{i}", i, None) for i in range(50)] + [("the", 1, 1)] * 2
    index = spark.createDataFrame(rows, "token string, `my id` long, c0 int").coalesce(1)
    found = index.mapInArrow(precompute._packed, "token string, `my id` array<bigint>, c0 array<int>").collect()
    assert len(found) == 51 and sum(len(r[1]) for r in found) == len(rows)
    monkeypatch.setattr(precompute, "PACKED_ROWS", 100)
    precompute.write_token_index(index, f"{tmp}/packed", 4)
    stored = spark.read.parquet(f"{tmp}/packed")
    assert stored.columns == ["token", "my id", "c0", "bucket"]
    assert sorted((tuple(r)[:3] for r in stored.collect()), key=str) == sorted(rows, key=str)
    precompute.write_token_index(index.filter("false"), f"{tmp}/none", 4)
