import os

import pytest
from pyspark.sql import functions as F

from keelson.sources import generate, jdbc, topic
from keelson.sources.tables import load_csv, read_table, register, stream_table

SF = "/root/testdata/sf0.001"


def test_load_csv_positional_permissive_strict(spark, tmp):
    path = os.path.join(tmp, "orders.csv")
    with open(path, "w") as f:
        f.write("customer_name,product_category,quantity\n"
                "Ann Lee,Books,2\nBo Kim,Toys,x\n")
    schema = "order_name string, product_category string, quantity bigint"
    df = load_csv(spark, path, schema, id_col="id")
    rows = df.orderBy("order_name").collect()
    assert df.columns == ["id", "order_name", "product_category", "quantity"]
    assert [(r.order_name, r.quantity) for r in rows] == [("Ann Lee", 2), ("Bo Kim", None)]
    assert len({r.id for r in rows}) == 2
    with pytest.raises(Exception):
        load_csv(spark, path, schema, strict=True).collect()


def test_tables_view_and_stream_source(spark):
    orders = read_table(spark, SF, "orders")
    register(orders, "orders_v")
    n = spark.sql("SELECT count(*) AS n FROM orders_v").first().n
    assert n == orders.count() > 0
    s = stream_table(spark, SF, "orders")
    assert s.isStreaming and s.schema == orders.schema


def test_topic_options_and_messages(spark):
    o = topic.source_options(["b1:9092", "b2:9092"], "logs", max_offsets=1000, ending="latest")
    assert o == {"kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "logs",
                 "startingOffsets": "earliest", "failOnDataLoss": "false",
                 "endingOffsets": "latest", "maxOffsetsPerTrigger": "1000"}
    df = spark.createDataFrame([(1, "Alice"), (1, "Alice-updated"), (2, "Bob")], "id int, name string")
    keyed = topic.to_messages(df, key="id").collect()
    assert [(r.key, r.value) for r in keyed][0] == ("1", '{"id":1,"name":"Alice"}')
    assert topic.to_messages(df).columns == ["value"]


def test_jdbc_options():
    o = jdbc.read_options("jdbc:postgresql://db/x", "people_big", {"user": "u"}, key="id",
                          bounds=(1, 1000000), parts=8)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "8"
    assert o["lowerBound"] == "1" and o["upperBound"] == "1000000" and o["user"] == "u"
    assert "partitionColumn" not in jdbc.read_options("u", "t")
    with pytest.raises(ValueError):
        jdbc.read_options("u", "t", key="id", parts=4)


def test_generators_deterministic_and_in_range(spark):
    a = generate.make_orders(spark, 2000, seed=1)
    b = generate.make_orders(spark, 2000, seed=1)
    assert a.exceptAll(b).count() == 0
    stats = a.agg(F.min("quantity"), F.max("quantity"), F.min("order_date"),
                  F.max("order_date"), F.countDistinct("product_category")).first()
    assert tuple(stats)[:2] == (1, 5)
    assert str(stats[2]) >= "2024-01-01" and str(stats[3]) <= "2025-12-31"
    assert stats[4] == 10
    for cat, lo, hi in generate.CATEGORY_PRICES:
        r = a.filter(F.col("product_category") == cat).agg(F.min("price_per_unit"),
                                                            F.max("price_per_unit")).first()
        assert r[0] is None or (lo <= r[0] and r[1] <= hi)
    p = generate.make_people(spark, 3000, seed=2)
    eng = p.filter(F.col("department").contains("Engineering")).agg(
        F.min("salary"), F.max("salary")).first()
    assert 80000 <= eng[0] and eng[1] <= 150000
    assert p.select("country").distinct().count() <= 93


def test_null_blank_and_broken_json_is_dropped(spark):
    from keelson.functions.json import parse_json_rows
    values = ['{"a": 1}', None, "", "  ", "{broken", '{"a": null}', "[]"]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert sorted(str(r.a) for r in parse_json_rows(df, "value", "a INT").collect()) in (["1", "None"], ["1", "None", "None"])


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    import pytest
    from keelson import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_index_is_built_once(spark):
    from keelson.plans import batch
    d = "/root/testdata/sf0.001"
    batch.token_search(spark, d).count()
    known = dict(batch._INDEXES)
    batch.token_search_all(spark, d).count()
    assert batch._INDEXES == known


def test_save_table_partitions_and_catalog(spark, tmp):
    from keelson.sources.tables import save_table
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    save_table(df, f"{tmp}/t", partition_by=["k"])
    assert spark.read.parquet(f"{tmp}/t").where("k = 'b'").count() == 1


def test_alert_writers_add_the_batch_id(spark, monkeypatch):
    from keelson.sources import jdbc, topic
    from keelson.streaming import run
    sent = []
    monkeypatch.setattr(topic, "write_topic", lambda df, *a: sent.append((df.collect(), a)))
    monkeypatch.setattr(jdbc, "append_jdbc", lambda df, *a: sent.append((df.collect(), a)))
    df = spark.createDataFrame([(1, "x")], "id int, k string")
    run.topic_writer("host:9092", "alerts", key="id")(df, 7)
    run.jdbc_writer("jdbc:x", "alerts")(df, 8)
    assert [(r[0].asDict(), a[1]) for r, a in sent] == [({"id": 1, "k": "x", "batch_id": 7}, "alerts"),
                                                       ({"id": 1, "k": "x", "batch_id": 8}, "alerts")]


def test_token_search_sees_a_rewritten_table(spark, tmp):
    from keelson.plans import batch
    for text, found in (("the first", [1]), ("nothing here", []), ("again the one", [1])):
        spark.createDataFrame([(1, text)], "doc_id bigint, text string").write.mode("overwrite").parquet(f"{tmp}/documents.parquet")
        assert [r["doc_id"] for r in batch.token_search(spark, tmp).collect()] == found
