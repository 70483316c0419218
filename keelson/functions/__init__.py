"""Column-expression helpers: all JVM-side, inside whole-stage codegen."""

from keelson.functions.decimal import decode_decimal, encode_decimal
from keelson.functions.text import contains_ci, contains_cs, tokens
from keelson.functions.time import epoch_to_ts, event_time, to_ntz
from keelson.functions.json import parse_json

__all__ = ["decode_decimal", "encode_decimal", "contains_ci", "contains_cs", "tokens",
           "epoch_to_ts", "event_time", "to_ntz", "parse_json"]
