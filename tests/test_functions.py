import base64
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from keelson.functions.decimal import decode_b64_decimal, encode_decimal
from keelson.functions.text import contains_ci, contains_cs, tokens
from keelson.functions.time import epoch_to_ts


def _b64_of_cents(c):
    # minimal two's-complement length, as Java's BigInteger.toByteArray
    n = (c if c >= 0 else ~c).bit_length() // 8 + 1
    return base64.b64encode(c.to_bytes(n, "big", signed=True)).decode()


def test_decode_known_and_roundtrip(spark):
    cents = [50000, 0, 1, -1, -50000, 127, 128, -128, -129, 255, 256, 999999999999,
             -999999999999, 400001, 50001]
    rows = [(c, _b64_of_cents(c)) for c in cents]
    assert _b64_of_cents(50000) == "AMNQ"
    df = spark.createDataFrame(rows, "c long, s string")
    out = df.select("c", decode_b64_decimal("s", 2, 18).alias("d"),
                    encode_decimal(F.col("c") / 100).alias("e"), "s").collect()
    for r in out:
        assert r.d == Decimal(r.c) / 100
        assert r.e == r.s, (r.c, r.e, r.s)


def test_decode_rejects(spark):
    bad = ["", "!!", "abc", "AMN", "AMNQ=", "AAAAAAAAAAAAAAAAAAAAAAA=", None, "A MNQ"]
    df = spark.createDataFrame([(b,) for b in bad], "s string")
    vals = [r.d for r in df.select(decode_b64_decimal("s").alias("d")).collect()]
    assert vals == [None] * len(bad)


def test_decode_precision_overflow_is_null(spark):
    # 9 digits before the point do not fit decimal(10,2)
    big = _b64_of_cents(100_000_000_00)
    df = spark.createDataFrame([(big,)], "s string")
    assert df.select(decode_b64_decimal("s").alias("d")).first().d is None
    assert df.select(decode_b64_decimal("s", 2, 12).alias("d")).first().d == Decimal("100000000.00")


def test_text_predicates(spark):
    df = spark.createDataFrame([("App CRASH now",), ("crashed",), ("no",), (None,)], "t string")
    ci = [r.x for r in df.select(contains_ci("t", "crash").alias("x")).collect()]
    cs = [r.x for r in df.select(contains_cs("t", "crash").alias("x")).collect()]
    assert ci == [True, True, False, None]
    assert cs == [False, True, False, None]


def test_tokens_whole_words_unicode(spark):
    df = spark.createDataFrame([("Élan, the THE-other; naïve42 ..",)], "t string")
    toks = set(df.select(tokens("t").alias("k")).first().k)
    assert toks == {"élan", "the", "other", "naïve42"}


def test_epoch_units(spark):
    df = spark.createDataFrame([(1768899230,)], "s long")
    r = df.select(epoch_to_ts(F.col("s"), "s").alias("a"),
                  epoch_to_ts(F.col("s") * 1000, "ms").alias("b"),
                  epoch_to_ts(F.col("s") * 1000000, "us").alias("c")).first()
    want = dt.datetime(2026, 1, 20, 8, 53, 50)
    assert r.a.replace(tzinfo=None) == want == r.b.replace(tzinfo=None) == r.c.replace(tzinfo=None)


def test_limb_sums_exact_for_large_and_negative(spark):
    from keelson.functions.decimal import limb_sums, limb_total
    vals = [9_000_000_000_000_000_000, 9_000_000_000_000_000_000, -5, 123456789012345,
            -9_000_000_000_000_000_000, 1, (1 << 21) - 1, -(1 << 42)]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(vals)], "g int, v long")
    out = df.groupBy("g").agg(*limb_sums("v", "x")).select("g", limb_total("x").alias("t"))
    got = {r.g: r.t for r in out.collect()}
    want = {g: sum(v for i, v in enumerate(vals) if i % 2 == g) for g in (0, 1)}
    assert got == {g: Decimal(w) for g, w in want.items()}
    # a plain bigint sum of the same rows overflows (ANSI raises)
    assert sum(vals[0:2]) > (1 << 63) - 1


def test_units_and_scaled_total(spark):
    from keelson.functions.decimal import limb_sums, limb_total, units
    df = spark.createDataFrame([(0.1, 3.0), (0.2, 3.0), (104997.88, 50.0)], "p double, q double")
    r = df.agg(*limb_sums(units("p") * units("q"), "r")).select(limb_total("r", 4).alias("t")).first()
    assert r.t == Decimal("0.9") + Decimal("5249894.00")


def test_spread_only_when_under_split(spark):
    from keelson.sources.tables import spread
    one = spark.range(1000).coalesce(1)
    assert spread(one, "id", 4).rdd.getNumPartitions() == 4
    many = spark.range(1000, numPartitions=8)
    assert spread(many, "id", 4) is many
    assert sorted(r.id for r in spread(one, "id", 4).collect()) == list(range(1000))


def test_decode_random_values_property(spark):
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.integers(min_value=-(1 << 63), max_value=(1 << 63) - 1),
                    min_size=1, max_size=60))
    def check(vals):
        df = spark.createDataFrame([(v, _b64_of_cents(v)) for v in vals], "c long, s string")
        for r in df.select("c", decode_b64_decimal("s", 2, 38).alias("d"),
                           encode_decimal(F.col("c").cast("decimal(20,0)") / 100).alias("e"),
                           "s").collect():
            assert r.d == Decimal(r.c) / 100
            assert r.e == r.s
    check()


def test_wide_wire_decimals(spark):
    import base64
    from decimal import Decimal as D
    from keelson.functions.decimal import decode_b64_decimal

    def wire(n):
        return base64.b64encode(n.to_bytes(n.bit_length() // 8 + 1, "big", signed=True)).decode()
    values = [10**20, -10**20, 2**64, -(2**64), 2**71 - 1, 10**33, -1, 255, 2**63, -(2**63), -(2**63) - 1]
    df = spark.createDataFrame([(i, wire(v)) for i, v in enumerate(values)] + [(99, wire(2**130))], "i int, s string")
    got = {r.i: r.d for r in df.select("i", decode_b64_decimal("s", 2, 38).alias("d")).collect()}
    assert got == {**{i: D(v).scaleb(-2) for i, v in enumerate(values)}, 99: None}
    assert [r.d for r in df.where("i = 0").select(decode_b64_decimal("s", 2, 10).alias("d")).collect()] == [None]


def test_units_never_round(spark):
    import pytest
    from keelson.functions.decimal import units
    df = spark.createDataFrame([(0.1,), (1.005,), (None,), (-2.125,)], "x double")
    assert [r.u for r in df.select(units("x", 3).alias("u")).collect()] == [100, 1005, None, -2125]
    with pytest.raises(Exception, match="more than 2 decimals"):
        df.select(units("x", 2).alias("u")).collect()


def test_product_limbs_equal_plain_products(spark):
    import random
    from keelson.functions.decimal import limb_total, product_limb_sums
    draw = random.Random(7)
    some = lambda: draw.choice((-1, 1)) * draw.randrange(1 << draw.choice((3, 20, 31, 43, 52)))
    rows = [(i % 5, some(), some()) for i in range(2000)] + [(9, None, 1 << 52), (9, 1 << 52, None), (9, -(1 << 52), (1 << 52) - 1)]
    df = spark.createDataFrame(rows, "g int, a long, b long")
    out = df.groupBy("g").agg(*product_limb_sums("a", "b", "x")).select("g", limb_total("x").alias("t"))
    want = {g: sum(a * b for k, a, b in rows if k == g and a is not None and b is not None) for g in (0, 1, 2, 3, 4, 9)}
    assert {r.g: int(r.t) for r in out.collect()} == want
