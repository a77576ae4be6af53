"""Parameters shared by the jobs, with their allowed ranges."""

from __future__ import annotations

from dataclasses import dataclass


def _within(name: str, value: float, low: float, high: float) -> None:
    if not low <= value <= high:
        raise ValueError(f"{name} must lie between {low} and {high}, got {value}")


@dataclass(frozen=True)
class Params:
    sample_days: int = 90
    horizon_days: int = 14
    overlap_days: int = 1
    interval_width: float = 0.95
    alert_after: int = 3
    source_tz: str = "UTC"
    precedence: str = "arrival"  # which row of a key counts: of the load that arrived last, or ("load_date") that has the latest date
    in_place: bool = True  # rewrite touched partitions only; False publishes a whole new layer at once

    def __post_init__(self) -> None:
        # Allowed ranges.
        _within("sample_days", self.sample_days, 7, 365)
        _within("horizon_days", self.horizon_days, 7, 60)
        _within("overlap_days", self.overlap_days, 0, 7)
        _within("interval_width", self.interval_width, 0.01, 0.9999)
        _within("alert_after", self.alert_after, 1, 365)
        if self.precedence not in ("arrival", "load_date"):
            raise ValueError(f"precedence must be arrival or load_date, got {self.precedence}")
