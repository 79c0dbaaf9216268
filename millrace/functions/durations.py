"""Duration strings such as ``100ms``, ``30s``, ``5m`` or ``1h 30m``."""

from __future__ import annotations

import re

# Duration units and their length in microseconds.
UNIT_MICROS = {
    "us": 1,
    "ms": 1_000,
    "s": 1_000_000,
    "sec": 1_000_000,
    "m": 60_000_000,
    "min": 60_000_000,
    "h": 3_600_000_000,
    "hr": 3_600_000_000,
    "d": 86_400_000_000,
    "day": 86_400_000_000,
    "w": 604_800_000_000,
    "week": 604_800_000_000,
}

_PART = re.compile(r"\s*(\d+)\s*([a-z]+)\s*")


def duration_micros(text: str) -> int:
    """Length in microseconds; raises ``ValueError`` on anything unreadable."""
    position, total = 0, 0
    for part in _PART.finditer(text):
        if part.start() != position:
            break
        unit = part.group(2)
        if unit not in UNIT_MICROS and unit.endswith("s"):
            unit = unit[:-1]
        if unit not in UNIT_MICROS:
            raise ValueError(f"unknown duration unit in {text!r}")
        total += int(part.group(1)) * UNIT_MICROS[unit]
        position = part.end()
    if position == 0 or position != len(text):
        raise ValueError(f"not a duration: {text!r}")
    return total


def duration_seconds(text: str | int) -> int:
    """Whole seconds.  Anything below one second is refused, not rounded to 0."""
    micros = text * 1_000_000 if isinstance(text, int) else duration_micros(text)
    if micros < 1_000_000:
        raise ValueError(f"a schedule needs at least one second, got {text!r}")
    return micros // 1_000_000
