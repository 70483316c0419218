"""Seeded table generators at any row count (S10, S11), for load and
benchmark runs. Rows are a pure function of ``(id, seed)`` through
``xxhash64``, so generation is embarrassingly parallel (``spark.range``
split over tasks), needs no driver-side data, and reruns identically.
Name pools are generated by rule; only the small value tables that shape the
data are fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Salary band per department family (low, high), chosen by a
# keyword in the department name; anything else gets the default band.
SALARY_BANDS = [
    ("Engineering", 80000, 150000),
    ("Platform", 80000, 150000),
    ("Data", 85000, 160000),
    ("Analytics", 85000, 160000),
    ("Support", 50000, 90000),
    ("Customer", 50000, 90000),
]
DEFAULT_BAND = (60000, 110000)

# Product categories and their unit price range (low, high).
CATEGORY_PRICES = [
    ("Electronics", 100, 1500),
    ("Fashion", 10, 200),
    ("Home & Garden", 20, 500),
    ("Sports", 15, 400),
    ("Toys", 5, 150),
    ("Books", 5, 80),
    ("Health & Beauty", 10, 300),
    ("Automotive", 50, 2000),
    ("Grocery", 2, 100),
    ("Office Supplies", 5, 250),
]

_FAMILIES = ["Engineering", "Platform", "Data", "Analytics", "Support", "Customer",
             "Finance", "Legal", "Marketing", "Sales", "Operations", "Research"]


def _u(seed: int, salt: str) -> Column:
    """Uniform [0, 1) from the row id, the seed and a per-column salt."""
    h = F.xxhash64(F.col("id"), F.lit(seed), F.lit(salt))
    return F.pmod(h, F.lit(1 << 40)).cast("double") / float(1 << 40)


def _pick(values: list[str], u: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(u * len(values)) + 1).cast("int"))


def make_people(spark: SparkSession, n: int, seed: int = 42, departments: int = 85,
                countries: int = 93, partitions: int | None = None) -> DataFrame:
    """``id, first_name, last_name, gender, department, salary, country``."""
    depts = [f"{_FAMILIES[i % len(_FAMILIES)]} {i // len(_FAMILIES) + 1}"
             for i in range(departments)]
    lands = [f"Country {i + 1:03d}" for i in range(countries)]
    base = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(n)
    gender = F.when(_u(seed, "g") < 0.5, "Male").otherwise("Female")
    dept = _pick(depts, _u(seed, "d"))
    lo, hi = F.lit(DEFAULT_BAND[0]), F.lit(DEFAULT_BAND[1])
    for word, l, h in reversed(SALARY_BANDS):
        hit = dept.contains(word)
        lo, hi = F.when(hit, l).otherwise(lo), F.when(hit, h).otherwise(hi)
    salary = (lo + F.floor(_u(seed, "s") * (hi - lo + 1))).cast("int")
    first = F.concat(F.when(gender == "Male", F.lit("M")).otherwise(F.lit("F")),
                     F.lit("name"), F.floor(_u(seed, "f") * 60).cast("string"))
    last = F.concat(F.lit("Surname"), F.floor(_u(seed, "l") * 60).cast("string"))
    return base.select(F.col("id").cast("bigint").alias("id"), first.alias("first_name"),
                       last.alias("last_name"), gender.alias("gender"),
                       dept.alias("department"), salary.alias("salary"),
                       _pick(lands, _u(seed, "c")).alias("country"))


def make_orders(spark: SparkSession, n: int, seed: int = 42, names: int = 1056,
                countries: int = 15, partitions: int | None = None) -> DataFrame:
    """``id, order_name, product_category, quantity, price_per_unit,
    order_date, country``; quantity 1-5, price uniform in the category range
    to 2 digits, date uniform in 2024-01-01 .. 2025-12-31."""
    base = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(n)
    cats = [c for c, _, _ in CATEGORY_PRICES]
    cat = _pick(cats, _u(seed, "cat"))
    lo, hi = F.lit(10.0), F.lit(500.0)
    for c, l, h in CATEGORY_PRICES:
        lo, hi = F.when(cat == c, float(l)).otherwise(lo), F.when(cat == c, float(h)).otherwise(hi)
    price = F.round(lo + _u(seed, "p") * (hi - lo), 2)
    days = F.floor(_u(seed, "day") * 731).cast("int")  # 2024-01-01 .. 2025-12-31
    name = F.concat(F.lit("Customer "), F.floor(_u(seed, "n") * names).cast("string"))
    return base.select(
        F.col("id").cast("bigint").alias("id"), name.alias("order_name"),
        cat.alias("product_category"),
        (F.floor(_u(seed, "q") * 5) + 1).cast("bigint").alias("quantity"),
        price.alias("price_per_unit"),
        F.date_add(F.lit("2024-01-01").cast("date"), days).alias("order_date"),
        _pick([f"Country {i + 1:02d}" for i in range(countries)], _u(seed, "cn")).alias("country"))


# Severities of log records, and the content phrases.
SEVERITIES = ["Low", "Medium", "High", "Critical"]
CONTENTS = ["User login ok", "App CRASH on start", "crash in payment module",
            "Timeout contacting service", "vulnerability scan finished", "Page rendered"]


def make_logs(spark: SparkSession, n: int, seed: int = 42, users: int = 2000,
              start_ms: int = 1768899230000, rate_per_s: int = 50_000,
              partitions: int | None = None) -> DataFrame:
    """Log records as JSON text (the topic value of the log stream), one
    ``value`` column: ``timestamp`` (epoch ms, ``rate_per_s`` records per
    second of event time with up to 5 s of disorder), ``status``,
    ``severity``, ``source_ip``, ``user_id``, ``content``."""
    base = spark.range(0, n, numPartitions=partitions) if partitions else spark.range(n)
    ts = (F.lit(start_ms) + (F.col("id") * 1000 / rate_per_s).cast("bigint")
          - F.floor(_u(seed, "late") * 5000).cast("bigint"))
    rec = F.struct(
        ts.alias("timestamp"),
        F.when(_u(seed, "st") < 0.9, "200").otherwise("500").alias("status"),
        _pick(SEVERITIES, _u(seed, "sev")).alias("severity"),
        F.concat(F.lit("10.0."), F.floor(_u(seed, "ip") * 256).cast("string"), F.lit("."),
                 F.floor(_u(seed, "ip2") * 256).cast("string")).alias("source_ip"),
        F.concat(F.lit("user_"), F.floor(_u(seed, "u") * users).cast("string")).alias("user_id"),
        _pick(CONTENTS, _u(seed, "c")).alias("content"))
    return base.select(F.to_json(rec).alias("value"))
