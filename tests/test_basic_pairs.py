import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from keelson.operators import basic, pairs

PEOPLE = [("Alice", "Engineering", 95000, "USA"), ("Bob", "Data", 105000, "USA"),
          ("Carla", "Support", 60000, "UK"), ("Dan", "Engineering", 120000, "USA"),
          ("Eve", "Data", 99000, "Germany"), ("Finn", "Support", 52000, "UK"),
          ("Gia", "Engineering", 88000, "France"), ("Hal", "Sales", 70000, "USA"),
          ("Ida", "Sales", 75000, "Spain"), ("Jon", "Data", 101000, "USA")]


@pytest.fixture()
def people(spark):
    return spark.createDataFrame(PEOPLE, "name string, department string, salary int, country string")


def test_pair_counts_people(people):
    # USA 5, UK 2, Germany, France, Spain 1 each: 25 + 4 + 1 + 1 + 1
    assert pairs.pair_count(people, "country").first().pair_count == 32
    assert pairs.pair_count_join(people, "country").first().pair_count == 32


def test_pair_counts_nulls_and_empty(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,)], "k string")
    assert pairs.pair_count(df, "k").first().pair_count == 4
    assert pairs.pair_count_join(df, "k").first().pair_count == 4
    empty = df.filter("false")
    assert pairs.pair_count(empty, "k").first().pair_count == 0
    assert pairs.pair_count_join(empty, "k").first().pair_count == 0


def test_pair_count_join_two_tables_random(spark):
    rnd = random.Random(7)
    left = [(rnd.choice([None, 1, 2, 3, 4]),) for _ in range(300)]
    right = [(rnd.choice([None, 2, 3, 5]),) for _ in range(200)]
    cl = Counter(k for (k,) in left if k is not None)
    cr = Counter(k for (k,) in right if k is not None)
    want = sum(cl[k] * cr[k] for k in cl)
    l_df = spark.createDataFrame(left, "k int")
    r_df = spark.createDataFrame(right, "k int")
    assert pairs.pair_count_join(l_df, "k", r_df).first().pair_count == want


def test_avg_by_and_nested(people):
    a = basic.avg_by(people, "department", "salary", n=10, alias="avg_salary").collect()
    assert [r.department for r in a] == ["Support", "Sales", "Engineering", "Data"]
    pdf = pd.DataFrame(PEOPLE, columns=["name", "department", "salary", "country"])
    want = pdf.groupby("department").salary.mean().round(2)
    assert {r.department: r.avg_salary for r in a} == want.to_dict()
    nested = basic.avg_of_avg(people, "country", "department", "salary", n=10).collect()
    inner = pdf.groupby(["country", "department"]).salary.mean().groupby("country").mean()
    assert {r.country: r.avg_value for r in nested} == pytest.approx(inner.to_dict())
    # plain average differs where inner groups are unequal in size
    assert inner["USA"] != pdf[pdf.country == "USA"].salary.mean()


def test_top_n_tie_break(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0), (4, None)], "id int, v double")
    assert [r.id for r in basic.top_n(df, "v", 3, tie=["id"]).collect()] == [2, 3, 1]
    assert [r.id for r in basic.top_n(df, "v", 1, tie=["id"]).collect()] == [2]


def test_revenue_exact_and_top(spark):
    rows = [("a", 0.1, 3.0), ("a", 0.2, 3.0), ("b", 0.3, 1.0), ("c", 1.0, 0.0)]
    df = spark.createDataFrame(rows, "k string, p double, q double")
    out = basic.revenue_by(df, "k", "p", "q", alias="rev").collect()
    assert [(r.k, r.rev) for r in out] == [("a", 0.9), ("b", 0.3), ("c", 0.0)]
    assert [r.k for r in basic.top_revenue(df, "k", "p", "q", k=2).collect()] == ["a", "b"]


def test_top_sum_and_match_count_and_rowcount(spark):
    df = spark.createDataFrame([("x", 1, "High", "App CRASH"), ("y", 5, "High", "crash"),
                                ("x", 2, "Low", "crash"), ("z", 5, "Critical", "ok")],
                               "k string, q int, severity string, content string")
    assert [r.k for r in basic.top_sum(df, "k", "q", k=3).collect()] == ["y", "z", "x"]
    mc = basic.match_count(df, "k", F.lower("content").contains("crash")
                           & F.col("severity").isin("High", "Critical")).collect()
    assert [(r.k, r.match_count) for r in mc] == [("x", 1), ("y", 1)]
    assert basic.row_count(df.filter("false")).first().row_count == 0


def test_revenue_of_three_digit_prices_is_exact(spark):
    from keelson.operators import basic
    df = spark.createDataFrame([("a", 0.257 if i % 2 else 0.256, 1.0) for i in range(100)], "k string, p double, q double")
    assert [tuple(r) for r in basic.revenue_by(df, "k", "p", "q").collect()] == [("a", 25.65)]


def test_revenue_of_products_beyond_a_long(spark):
    from keelson.operators import basic
    rows = [("a", 1e7, 1e6), ("a", 0.001, 0.001), ("b", -4e9, 8e11), ("b", 4e9, 8e11), ("b", 2.5, 2.0), ("c", -6e12, 6e12),
            ("d", None, 9e12), ("d", 3.0, None), ("e", 9e12, None)]
    df = spark.createDataFrame(rows, "k string, p double, q double")
    got = {r.k: r.revenue for r in basic.revenue_by(df, "k", "p", "q", wide=True).collect()}
    assert got == {"a": 1e13, "b": 5.0, "c": -3.6e25, "d": None, "e": None}
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        basic.revenue_by(df, "k", "p", "q").collect()
