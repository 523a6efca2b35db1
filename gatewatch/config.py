"""Job parameters. Durations are strings such as ``"9 seconds"``."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
    "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_us(text: str) -> int:
    """``"6 hours"`` -> microseconds. Accepts sums such as ``"1 hour 30 minutes"``."""
    total = 0
    parts = re.findall(r"(\d+)\s*([a-zA-Z]+)", text)
    if not parts:
        raise ValueError(f"bad duration {text!r}")
    for n, unit in parts:
        u = unit.lower().rstrip("s")
        if u not in _UNITS_US:
            raise ValueError(f"bad duration unit {unit!r} in {text!r}")
        total += int(n) * _UNITS_US[u]
    return total


@dataclass(frozen=True)
class WindowSpec:
    """Sliding window of ``duration`` advancing by ``slide`` (event time).

    The reference runs 9 s / 3 s windows; the fixtures use 1 day / 6 hours."""
    duration: str = "9 seconds"
    slide: str = "3 seconds"
    # A gap strictly below this counts as a too-fast repeat (ms).
    fast_repeat_ms: int = 10_000
    # Time buckets used to split the per-address gap sort (must divide slide).
    gap_bucket: str | None = None

    @property
    def dur_us(self) -> int:
        return duration_us(self.duration)

    @property
    def slide_us(self) -> int:
        return duration_us(self.slide)

    @property
    def panes(self) -> int:
        if self.dur_us % self.slide_us:
            raise ValueError("window duration must be a multiple of the slide")
        return self.dur_us // self.slide_us

    @property
    def bucket_us(self) -> int:
        if self.gap_bucket is None:
            b = min(self.slide_us, 60_000_000)
            while self.slide_us % b:
                b -= 1_000_000 if b > 1_000_000 else 1
            return b
        b = duration_us(self.gap_bucket)
        if self.slide_us % b:
            raise ValueError("gap bucket must divide the slide")
        return b


FIXTURE_WINDOW = WindowSpec("1 day", "6 hours")
REFERENCE_WINDOW = WindowSpec("9 seconds", "3 seconds")

# Blacklist entry lifetime and monitor snapshot lifetime (seconds) - fixed values.
BLACKLIST_TTL_S = 3600
MONITOR_TTL_S = 86400

# Wire separator of raw and processed records - fixed value.
FIELD_SEP = "#CS#"
# Blacklist key prefix - fixed value.
BLACKLIST_KEY_PREFIX = "CSANTI_ANTI_BLACK"


@dataclass
class Tables:
    """Rule tables as DataFrames (see sources.rules)."""
    filter_rule: object = None
    classify_rule: object = None
    parse_rule: object = None
    ip_blacklist: object = None
    critical_page: object = None
    process_info: object = None
    strategy: object = None
    rule: object = None
    rule_name: object = None
    extra: dict = field(default_factory=dict)
