"""A user holding a third of all rows must not become one task."""
import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from keelson.operators import fraud
from keelson.operators.ranks import dealt

T0 = dt.datetime(2024, 1, 1)


def _skewed(spark, n=9000, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        u = 0 if i % 3 == 0 else rnd.randrange(1, 300)   # user 0 holds a third
        t = T0 + dt.timedelta(seconds=rnd.randrange(0, 30 * 86400))
        rows.append((i, u, t, Decimal(rnd.randrange(100, 100000)) / 100))
    return spark.createDataFrame(rows, "id long, user long, ts timestamp_ntz, amount decimal(10,2)")


def test_hot_user_is_dealt_over_parts(spark, small_parts):
    df = _skewed(spark)
    large, rest = fraud.by_size(df, "user", 400)
    parts = dealt(large, "user", ["ts", "id"]).groupBy("_part").count()
    assert large.count() == 3000 and rest.count() == 6000
    assert parts.agg(F.max("count")).first()[0] <= 1.5 * 3000 / parts.count()


def test_chunked_forms_equal_plain_under_skew(spark):
    df = _skewed(spark)
    plain = fraud.profile(df, "user", "ts", "id", "amount", depth=50, chunk=None)
    auto = fraud.profile(df, "user", "ts", "id", "amount", depth=50, max_group_rows=400)
    cols = ["id", "prior_n", "prior_sum"]
    assert plain.select(*cols).exceptAll(auto.select(*cols)).count() == 0
    assert auto.count() == df.count()
    vp = fraud.velocity(df, "user", "ts", "id", "1 hour", chunk=None)
    va = fraud.velocity(df, "user", "ts", "id", "1 hour", max_group_rows=400)
    assert vp.select("id", "velocity").exceptAll(va.select("id", "velocity")).count() == 0
    assert va.count() == df.count()
