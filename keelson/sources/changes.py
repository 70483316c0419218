"""Change-data feeds.

A change event is JSON ``{"op": "c", "after": {...}}``, or the same wrapped in
``{"payload": ...}`` as connectors with schemas emit it. ``read_changes``
accepts both in one pass and yields the ``after`` row plus ``op``; events
without an ``after`` (deletes, tombstones) and malformed JSON fall out.
Money columns arrive as base64 bytes of the unscaled value (or, without the
connector's decimal handling, as bare numbers); they are parsed as
``variant`` so the JSON type decides which rule applies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType, VariantType

from keelson.functions.decimal import decode_decimal, encode_decimal
from keelson.functions.json import CORRUPT, keep_rows


def envelope_schema(after: StructType) -> StructType:
    inner = StructType([StructField("op", StringType()), StructField("after", after)])
    return StructType([StructField("payload", inner),
                       StructField("op", StringType()), StructField("after", after),
                       StructField(CORRUPT, StringType())])


# Change operations that carry a new row -- create, snapshot
# read, update (a delete carries no ``after``).
NEW_ROW_OPS = ("c", "r", "u")


def read_changes(df: DataFrame, after: StructType, value_col: str = "value",
                 decimals: Sequence[str] = (), scale: int = 2,
                 precision: int = 10, ops: Sequence[str] | None = None) -> DataFrame:
    """Change events -> ``op`` + the flat ``after`` columns.

    Columns named in ``decimals`` must be ``variant`` in ``after``; they are
    decoded to ``decimal(precision, scale)``, null when undecodable. ``ops``
    keeps only those operations (e.g. ``("c", "r")``: inserts and snapshot
    reads, for consumers that treat each event as a new transaction).
    """
    ev = F.from_json(F.col(value_col).cast("string"), envelope_schema(after),
                     {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("e")
    parsed = df.select(ev)
    row = F.struct(F.coalesce(F.col("e.payload.op"), F.col("e.op")).alias("op"),
                   F.coalesce(F.col("e.payload.after"), F.col("e.after")).alias("after"),
                   F.col(f"e.{CORRUPT}").alias("bad"))
    # events without `after` (deletes), malformed JSON and values of another
    # type than the schema's are dropped inside a generator, so each record is
    # parsed once; the same rule as for plain JSON records
    fine = lambda r: r["after"].isNotNull() & r["bad"].isNull()
    keep = fine if ops is None else (lambda r: fine(r) & r["op"].isin(*ops))
    out = keep_rows(parsed, row, keep).select("op", "after.*")
    for c in decimals:
        out = out.withColumn(c, decode_decimal(F.col(c), scale, precision))
    return out


def after_schema(fields: Sequence[tuple[str, object]]) -> StructType:
    """Build an ``after`` struct; ``"variant"`` marks a wire-decimal column."""
    out = []
    for name, typ in fields:
        out.append(StructField(name, VariantType() if typ == "variant" else typ))
    return StructType(out)


def change_events(df: DataFrame, columns: Sequence[str], money: str, op: str = "c",
                  wrapped: Column | None = None, bare_number: Column | None = None,
                  scale: int = 2) -> DataFrame:
    """Encode rows as change events (the producer side, for replays and tests).

    ``money`` is sent as base64 bytes, or as a bare JSON number where
    ``bare_number`` is true; the envelope is wrapped in ``payload`` where
    ``wrapped`` is true.
    """
    others = [F.col(c) for c in columns if c != money]
    as_b64 = F.struct(*others, encode_decimal(money, scale).alias(money))
    as_num = F.struct(*others, F.col(money).cast(f"decimal(38,{scale})").alias(money))
    def env(after_struct, wrap):
        body = F.struct(F.lit(op).alias("op"), after_struct.alias("after"))
        return F.to_json(F.struct(body.alias("payload")) if wrap else body)
    wrap = wrapped if wrapped is not None else F.lit(True)
    bare = bare_number if bare_number is not None else F.lit(False)
    value = (F.when(bare & wrap, env(as_num, True)).when(bare, env(as_num, False))
             .when(wrap, env(as_b64, True)).otherwise(env(as_b64, False)))
    return df.select(value.alias("value"))
