import datetime as dt
import random
from decimal import Decimal

import pytest

from keelson.operators import fraud

T0 = dt.datetime(2024, 1, 1)


def _events(seed=3, n=600, users=(1, 2, 3, 4), hot=9):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        u = hot if rnd.random() < 0.4 else rnd.choice(users)
        # coarse seconds -> many equal times; spread over ~3 hours
        t = T0 + dt.timedelta(seconds=rnd.choice(range(0, 10800, 15)))
        a = None if rnd.random() < 0.05 else Decimal(rnd.choice(
            ["5.00", "20.00", "100.00", "499.99", "500.00", "500.01", "1600.00", "4000.00",
             "4000.01", "30.50"]))
        rows.append((i, u, t, a))
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id long, user long, ts timestamp_ntz, amount decimal(10,2)")


def _profile_ref(rows, depth, min_n=3, ratio=3, floor=Decimal("500")):
    out = {}
    hist = {}
    for i, u, t, a in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        h = hist.setdefault(u, [])
        if a is None:
            out[i] = (0, None, False)
            continue
        n, s = len(h), sum(h, Decimal(0))
        flag = n >= min_n and a * n > ratio * s and a > floor
        out[i] = (n, s if n else None, flag)
        h.append(a)
        if len(h) > depth:
            h.pop(0)
    return out


@pytest.mark.parametrize("depth,chunk,cap", [(5, "10 minutes", 0), (50, "20 minutes", 0),
                                             (3, "1 minute", 0), (50, None, 0),
                                             (5, "auto", 10_000), (5, "auto", 40)])
def test_profile_matches_loop(spark, depth, chunk, cap):
    rows = _events()
    df = _frame(spark, rows)
    prof = fraud.profile(df, "user", "ts", "id", "amount", depth=depth, chunk=chunk,
                         max_group_rows=cap or 2_000_000)
    flagged = fraud.flag_outliers(prof, "amount", floor=500.0, min_n=3)
    got = {r.id: (r.prior_n, r.prior_sum, r.is_outlier) for r in flagged.collect()}
    assert got == _profile_ref(rows, depth)


def test_profile_stdev_matches_statistics(spark):
    import statistics
    rows = [(i, 1, T0 + dt.timedelta(minutes=i), Decimal(v)) for i, v in
            enumerate(["10.00", "20.00", "40.00", "80.00", "80.00"])]
    out = fraud.profile(_frame(spark, rows), "user", "ts", "id", "amount", depth=3,
                        chunk="2 minutes").orderBy("id").collect()
    assert out[0].prior_stdev == 0.0 and out[1].prior_stdev == 0.0
    assert out[4].prior_stdev == pytest.approx(statistics.stdev([20, 40, 80]))
    assert out[4].prior_avg == pytest.approx(140 / 3)


def test_outlier_boundaries(spark):
    base = [(i, 7, T0 + dt.timedelta(seconds=i), Decimal("100.00")) for i in range(3)]
    cases = [Decimal("500.00"), Decimal("500.01")]
    for k, a in enumerate(cases):
        rows = base + [(10, 7, T0 + dt.timedelta(seconds=10), a)]
        prof = fraud.profile(_frame(spark, rows), "user", "ts", "id", "amount")
        r = fraud.flag_outliers(prof, "amount").filter("id = 10").first()
        assert r.is_outlier is (k == 1)
    # only two prior rows: never flagged
    rows = base[:2] + [(10, 7, T0 + dt.timedelta(seconds=10), Decimal("9000.00"))]
    prof = fraud.profile(_frame(spark, rows), "user", "ts", "id", "amount")
    assert fraud.flag_outliers(prof, "amount").filter("id = 10").first().is_outlier is False


def _velocity_ref(rows, span_s):
    valid = [r for r in rows if r[3] is not None]
    out = {}
    for i, u, t, a in rows:
        if a is None:
            out[i] = None
            continue
        out[i] = sum(1 for j, v, s, b in valid if v == u and s >= t - dt.timedelta(seconds=span_s)
                     and (s, j) <= (t, i))
    return out


@pytest.mark.parametrize("span,span_s,chunk,cap", [("60 seconds", 60, "2 minutes", 0),
                                                   ("60 seconds", 60, "auto", 30),
                                                   ("60 seconds", 60, "auto", 0),
                                                   ("15 minutes", 900, "15 minutes", 0),
                                                   ("60 seconds", 60, None, 0)])
def test_velocity_matches_loop(spark, span, span_s, chunk, cap):
    rows = _events(seed=5, n=500)
    v = fraud.velocity(_frame(spark, rows), "user", "ts", "id", span=span, amount="amount",
                       chunk=chunk, max_group_rows=cap or 2_000_000)
    got = {r.id: r.velocity for r in v.collect()}
    assert got == _velocity_ref(rows, span_s)


def test_velocity_exact_boundary_and_ties(spark):
    rows = [(1, 1, T0, Decimal("1")), (2, 1, T0 + dt.timedelta(seconds=60), Decimal("1")),
            (3, 1, T0 + dt.timedelta(seconds=60), Decimal("1")),
            (4, 1, T0 + dt.timedelta(seconds=61), Decimal("1"))]
    got = {r.id: r.velocity for r in fraud.velocity(_frame(spark, rows), "user", "ts", "id",
                                                    "60 seconds", chunk="1 minute").collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 3}


def test_score_boundaries(spark):
    rows = [(1, 5, Decimal("4000.00")), (2, 6, Decimal("4000.00")), (3, 6, Decimal("4000.01")),
            (4, 5, Decimal("4000.01")), (5, 9, None)]
    df = spark.createDataFrame(rows, "id long, velocity long, amount decimal(10,2)")
    got = {r.id: (r.score, r.alert) for r in fraud.fraud_score(df, "amount").collect()}
    assert got == {1: (0, False), 2: (40, False), 3: (90, True), 4: (50, False), 5: (0, False)}


def test_only_large_users_are_split(spark):
    df = _frame(spark, _events())
    assert fraud.by_size(df, "user", 10_000) is None
    large, rest = fraud.by_size(df, "user", 200)
    assert [r.user for r in large.select("user").distinct().collect()] == [9]
    assert large.count() + rest.count() == df.count() and rest.filter("user = 9").count() == 0


def _awkward():
    """Null users, null times, null amounts, a burst within seconds, and many equal times."""
    rnd = random.Random(8)
    rows = []
    for i in range(900):
        u = rnd.choice([1, 2, None])
        t = None if i % 11 == 0 else T0 + dt.timedelta(seconds=rnd.randrange(86400))
        rows.append((i, u, t, None if i % 13 == 0 else Decimal(rnd.randrange(1, 900))))
    rows += [(1000 + i, 5, T0 + dt.timedelta(seconds=rnd.randrange(20)), Decimal("7.00")) for i in range(600)]
    rows += [(2000 + i, 6, T0 + dt.timedelta(days=40), Decimal("9.00")) for i in range(500)]
    rows += [(3000 + i, 5, T0 + dt.timedelta(days=58, seconds=i), Decimal("8.00")) for i in range(3)]
    return rows


@pytest.mark.parametrize("chunk", ["auto", "1 day"])
def test_chunked_forms_equal_plain_on_awkward_rows(spark, chunk):
    df = _frame(spark, _awkward())
    for form in (lambda c: fraud.profile(df, "user", "ts", "id", "amount", depth=20, chunk=c, max_group_rows=50),
                 lambda c: fraud.velocity(df, "user", "ts", "id", "60 seconds", amount="amount", chunk=c, max_group_rows=50)):
        plain, split = form(None), form(chunk)
        assert split.count() == df.count()
        assert plain.exceptAll(split).count() == 0
    rows = {r.id: r.velocity for r in fraud.velocity(df, "user", "ts", "id", amount="amount", max_group_rows=50).collect()}
    assert rows[0] is None and rows[2499] == 500 and rows[3002] == 3


@pytest.mark.parametrize("seconds", [1, 80_000])
def test_velocity_marks_are_two_an_event_and_dealt_evenly(spark, small_parts, seconds):
    """One user holds everything, inside one span: no copies, no task with more than its share."""
    from pyspark.sql import functions as F
    from keelson.operators.ranks import dealt
    df = spark.range(40_000).select("id", F.lit(1).alias("user"), (F.col("id") % seconds * 1_000_000).alias("_t"))
    marks = fraud.velocity_marks(df, "user", "id", 86_400_000_000)
    assert marks.count() == 80_000
    for table in (dealt(df, "user", ["_t", "id"]), dealt(marks, "user", ["_when", "_kind", "_e"])):
        parts = [r["count"] for r in table.groupBy("_part").count().collect()]
        assert len(parts) >= 4 and max(parts) <= 2 * sum(parts) / len(parts)
    out = fraud.velocity(df.withColumn("ts", F.timestamp_micros("_t")).drop("_t"), "user", "ts", "id", "1 day", max_group_rows=1000)
    assert out.agg({"velocity": "max"}).first()[0] == 40_000 and out.agg({"velocity": "sum"}).first()[0] == 40_000 * 40_001 // 2


def test_profile_chunks_hold_equal_rows(spark):
    from keelson.operators.ranks import numbered
    df = _frame(spark, _awkward())
    sizes = numbered(df, "user", ["ts", "id"], "_n").groupBy("user", (fraud.F.col("_n") / 50).cast("int").alias("c")).count()
    assert sizes.agg({"count": "max"}).first()[0] == 50


def test_velocity_cost_is_linear(spark):
    """40,000 rows of one user inside one span, at distinct and at equal times."""
    import time
    from pyspark.sql import functions as F
    df = spark.range(40_000).select("id", F.lit(1).alias("user"), F.timestamp_seconds(F.col("id") % 80_000).alias("ts"))
    for ts in (F.col("ts"), F.lit(T0)):
        began = time.time()
        out = fraud.velocity(df.withColumn("ts", ts), "user", "ts", "id", "1 day", chunk=None)
        assert out.agg({"velocity": "max"}).first()[0] == 40_000
        assert time.time() - began < 10  # the sliding frame took 8 s (distinct) and 21 s (equal) on an idle machine


def test_ratio_rule_exact_at_equality(spark):
    # 3 x mean(33.35, 33.35, 33.35) == 100.05 exactly: not an outlier
    rows = [(i, 1, T0 + dt.timedelta(seconds=i), Decimal("33.35")) for i in range(3)]
    rows += [(9, 1, T0 + dt.timedelta(seconds=9), Decimal("100.05")),
             (10, 1, T0 + dt.timedelta(seconds=10), Decimal("9999.99"))]
    prof = fraud.profile(_frame(spark, rows), "user", "ts", "id", "amount", chunk=None)
    got = {r.id: r.is_outlier for r in fraud.flag_outliers(prof, "amount", floor=0.1).collect()}
    assert got[9] is False and got[10] is True


def test_sigma_rule(spark):
    rows = [(i, 1, T0 + dt.timedelta(seconds=i), Decimal(v))
            for i, v in enumerate(["100.00", "110.00", "90.00", "100.00", "131.00", "900.00"])]
    prof = fraud.profile(_frame(spark, rows), "user", "ts", "id", "amount", chunk=None)
    got = {r.id: r.is_outlier for r in fraud.flag_outliers(prof, "amount", rule="sigma",
                                                           k=3.0, floor=0.0).collect()}
    # mean 100, stdev 8.165: 131 > 124.5 flags; 900 flags; earlier rows lack history
    assert got == {0: False, 1: False, 2: False, 3: False, 4: True, 5: True}
