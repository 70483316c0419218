"""Parsing ``"60 seconds"``-style spans into microseconds (driver-side, tiny)."""

from __future__ import annotations

# Unit names accepted in span strings and their length in seconds.
_UNITS = {
    "microsecond": 1e-6, "microseconds": 1e-6, "us": 1e-6,
    "millisecond": 1e-3, "milliseconds": 1e-3, "ms": 1e-3,
    "second": 1, "seconds": 1, "s": 1, "sec": 1,
    "minute": 60, "minutes": 60, "min": 60, "m": 60,
    "hour": 3600, "hours": 3600, "h": 3600,
    "day": 86400, "days": 86400, "d": 86400,
    "week": 604800, "weeks": 604800,
}


def span_us(span) -> int:
    """``"10 minutes"`` -> 600_000_000; a number is taken as seconds."""
    if isinstance(span, (int, float)):
        return int(round(span * 1_000_000))
    parts = str(span).strip().lower().split()
    if len(parts) != 2 or parts[1] not in _UNITS:
        raise ValueError(f"cannot read span {span!r}; use e.g. '60 seconds'")
    return int(round(float(parts[0]) * _UNITS[parts[1]] * 1_000_000))
