"""JSON parsing against a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

CORRUPT = "_corrupt_record"


def _struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else _parse_datatype_string(schema)


def parse_json(col, schema: StructType | str) -> Column:
    """Bytes or text to a struct (PERMISSIVE: a malformed record gives a
    struct of nulls, never an error)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c.cast("string"), schema, {"mode": "PERMISSIVE"})


def keep_rows(df: DataFrame, row: Column, cond) -> DataFrame:
    """``row`` (a struct expression) expanded to columns where ``cond(row)``.

    The condition is applied inside a generator: as a ``Filter`` on a parsed
    column Catalyst would push it below the projection and evaluate the parse
    once more per reference."""
    return df.select(F.inline(F.filter(F.array(row), cond)))


def parse_json_rows(df: DataFrame, col, schema: StructType | str) -> DataFrame:
    """JSON values -> typed columns; malformed records are dropped
    (detected through the corrupt-record column, each record parsed once), and
    so are null and blank values."""
    st = _struct(schema)
    with_bad = StructType(list(st.fields) + [StructField(CORRUPT, StringType())])
    c = F.col(col) if isinstance(col, str) else col
    text = F.when(F.trim(c.cast("string")) != "", c.cast("string"))
    parsed = F.from_json(text, with_bad,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return keep_rows(df, parsed, lambda r: r.isNotNull() & r[CORRUPT].isNull()).drop(CORRUPT)
