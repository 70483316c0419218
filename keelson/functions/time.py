"""Time helpers (F6, F11) and the timestamp_ntz <-> timestamp bridge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_ts(col, unit: str = "ms") -> Column:
    """epoch number to timestamp; ``unit`` is ``s``, ``ms`` or ``us``.

    Direct conversion, no text round trip through ``from_unixtime``.
    """
    c = _c(col)
    if unit == "s":
        return F.timestamp_seconds(c)
    if unit == "ms":
        return F.timestamp_millis(c)
    if unit == "us":
        return F.timestamp_micros(c)
    raise ValueError(f"unit must be s, ms or us, not {unit!r}")


def event_time(col) -> Column:
    """A ``timestamp`` usable by ``withWatermark`` (which rejects
    ``timestamp_ntz``); with the session zone in UTC the wall clock is kept."""
    return _c(col).cast("timestamp")


def to_ntz(col) -> Column:
    """Back to ``timestamp_ntz`` for output next to the source tables."""
    return _c(col).cast("timestamp_ntz")
