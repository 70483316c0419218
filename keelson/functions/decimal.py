"""Exact decimals carried as base64 text of big-endian two's-complement bytes
(F8-F10), the way change-capture connectors ship ``NUMERIC`` columns.

Both directions are pure column expressions, so they stay in codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_B64 = r"^[A-Za-z0-9+/]+={0,2}$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_b64_decimal(col, scale: int = 2, precision: int = 10) -> Column:
    """base64 bytes -> ``decimal(precision, scale)``; anything
    undecodable -> null, never an error.

    Null for: foreign characters, a length not a multiple of 4, the empty
    string, more than 16 bytes, or a value outside the target precision.
    """
    s = _c(col)
    raw = F.try_to_binary(s, F.lit("base64"))
    h = F.hex(raw)
    negative = F.substring(h, 1, 1).isin("8", "9", "A", "B", "C", "D", "E", "F")
    # sign-extend to 64 bits, then read as a signed 64-bit number
    h16 = F.when(negative, F.lpad(h, 16, "F")).otherwise(F.lpad(h, 16, "0"))
    unscaled = F.conv(h16, 16, -10).cast("decimal(20,0)")
    well = s.rlike(_B64) & (F.length(s) % 4 == 0) & raw.isNotNull()
    value = (unscaled / F.lit(10 ** scale).cast("decimal(20,0)"))
    target = f"decimal({precision},{scale})"
    # 9 to 16 bytes: the signed upper half times 2^64, plus the unsigned lower half
    h32 = F.when(negative, F.lpad(h, 32, "F")).otherwise(F.lpad(h, 32, "0"))
    upper = F.conv(F.substring(h32, 1, 16), 16, -10).cast("decimal(38,0)")
    lower = F.conv(F.substring(h32, 17, 16), 16, 10).cast("decimal(38,0)")
    wide = F.try_add(F.try_multiply(upper, F.lit(Decimal(1 << 64)).cast("decimal(38,0)")), lower)
    wide = F.try_multiply(wide, F.lit(Decimal(1).scaleb(-scale)))
    size = F.length(raw)
    return (F.when(well & (size >= 1) & (size <= 8), value.try_cast(target))
            .when(well & (size > 8) & (size <= 16), wide.try_cast(target)))


def decode_decimal(variant_col, scale: int = 2, precision: int = 10) -> Column:
    """F8-F10 on a JSON value held as ``variant``: a JSON string is base64
    bytes, a JSON number passes through; other shapes give null."""
    v = _c(variant_col)
    kind = F.schema_of_variant(v)
    as_text = F.try_variant_get(v, "$", "string")
    as_num = F.try_variant_get(v, "$", f"decimal({precision},{scale})")
    return (F.when(kind == "STRING", decode_b64_decimal(as_text, scale, precision))
            .when(kind.rlike("^(DECIMAL|BIGINT|INT|DOUBLE|FLOAT|SMALLINT|TINYINT)"), as_num))


def encode_decimal(col, scale: int = 2) -> Column:
    """Inverse of :func:`decode_b64_decimal`: the minimal two's-complement
    big-endian bytes of the unscaled value, base64 encoded (as Java's
    ``BigInteger.toByteArray``). Used to replay tables as change feeds."""
    unscaled = F.round(_c(col) * F.lit(10 ** scale)).cast("bigint")
    h = F.hex(unscaled)
    even = F.when(F.length(h) % 2 == 1, F.concat(F.lit("0"), h)).otherwise(h)
    pos = F.when(F.substring(even, 1, 1).isin("8", "9", "A", "B", "C", "D", "E", "F"),
                 F.concat(F.lit("00"), even)).otherwise(even)
    # negative: hex() gives 16 digits; drop sign-only leading FF bytes
    neg = F.regexp_replace(h, r"^(FF)+(?=[89A-F])", "")
    return F.base64(F.unhex(F.when(unscaled < 0, neg).otherwise(pos)))


# Exact sums of integer amounts at long speed. Summing ``decimal`` goes
# through a Decimal object per row; summing ``bigint`` overflows near 9.2e18.
# Splitting each value into three 21-bit limbs keeps every partial sum a
# primitive long (safe for 2^42 ~ 4.4e12 rows per group) and exact; the limbs
# are recombined once per group as ``decimal(38,0)``.
_LIMB = 21
_MASK = (1 << _LIMB) - 1


def limb_sums(units, prefix: str) -> list[Column]:
    """Three aggregate columns whose recombination is ``sum(units)``."""
    u = _c(units).cast("bigint")
    return [F.sum(F.shiftright(u, 2 * _LIMB)).alias(f"{prefix}_hi"),
            F.sum(F.shiftright(u, _LIMB).bitwiseAND(F.lit(_MASK))).alias(f"{prefix}_mid"),
            F.sum(u.bitwiseAND(F.lit(_MASK))).alias(f"{prefix}_lo")]


def product_limb_sums(a, b, prefix: str) -> list[Column]:
    """:func:`limb_sums` of ``a * b`` for whole numbers below 2^53. A product
    beyond a long is put together from the factors' own limbs, in longs too;
    only a group's total of over 4e31 is an overflow error."""
    a, b = _c(a).cast("bigint"), _c(b).cast("bigint")
    product = F.try_multiply(a, b)
    limbs = lambda u: (u.bitwiseAND(F.lit(_MASK)), F.shiftright(u, _LIMB).bitwiseAND(F.lit(_MASK)),
                       F.shiftright(u, 2 * _LIMB))
    a0, a1, a2 = limbs(a)
    b0, b1, b2 = limbs(b)
    low = a0 * b0
    mid = a0 * b1 + a1 * b0 + F.shiftright(low, _LIMB)
    high = (a0 * b2 + a1 * b1 + a2 * b0 + F.shiftright(mid, _LIMB)
            + (a1 * b2 + a2 * b1) * F.lit(1 << _LIMB) + a2 * b2 * F.lit(1 << (2 * _LIMB)))
    wide = (low.bitwiseAND(F.lit(_MASK)), mid.bitwiseAND(F.lit(_MASK)), high)
    return [F.sum(F.when(product.isNotNull(), short).otherwise(long)).alias(f"{prefix}_{name}")
            for name, short, long in zip(("lo", "mid", "hi"), limbs(product), wide)]


def limb_total(prefix: str, scale: int = 0) -> Column:
    """Recombine :func:`limb_sums` into ``decimal(38, scale)``."""
    d = "decimal(38,0)"
    total = (F.col(f"{prefix}_hi").cast(d) * F.lit(1 << (2 * _LIMB)).cast(d)
             + F.col(f"{prefix}_mid").cast(d) * F.lit(1 << _LIMB).cast(d)
             + F.col(f"{prefix}_lo").cast(d)).cast(d)
    if scale:
        return (total / F.lit(10 ** scale).cast(d)).cast(f"decimal(38,{scale})")
    return total


def units(col, scale: int = 2) -> Column:
    """A value with at most ``scale`` decimals as an integer count of
    ``10^-scale`` units (cents for 2). A value with more decimals, or one too
    large to tell, is an error, never rounded: the count divided by
    ``10^scale`` has to give back the value itself."""
    c = _c(col)
    n = F.round(c * F.lit(10 ** scale)).cast("bigint")
    back = n.cast("double") / F.lit(float(10 ** scale))
    fits = (back == c.cast("double")) & (F.abs(n) < F.lit(1 << 53))
    return F.when(c.isNull() | fits, n).otherwise(F.raise_error(F.concat(
        F.lit(f"more than {scale} decimals: "), c.cast("string"))).cast("bigint"))
