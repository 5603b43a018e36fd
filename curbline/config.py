"""Tunable settings. Nothing here depends on a running session."""

from __future__ import annotations

from dataclasses import dataclass, field

# The ordinal tiers from least to most urgent, and the label of an unrated request.
TIERS: tuple[str, ...] = ("Low", "Medium", "High", "Critical")
UNKNOWN = "Unknown"
SLA_STATES: tuple[str, ...] = ("met", "missed", "pending", "excluded")
PARENT_LOCATIONS: tuple[str, ...] = ("in_extract", "outside_window", "not_found", "not_looked_up")


def _default_thresholds() -> dict[str, int]:
    # Hours allowed per tier. "Unknown" is absent on purpose, so it never has an SLA.
    return {"Critical": 4, "High": 24, "Medium": 72, "Low": 168}


@dataclass(frozen=True)
class Settings:
    sla_thresholds: dict[str, int] = field(default_factory=_default_thresholds)
    max_unparseable_close_time_pct: float = 0.01
    fiscal_year: int = 2026
    default_city: str = "chicago"
    default_status: str = "open"
    backfill_reason: str = "Backfilled — LLM classification skipped."
    prompt_version: str = "v1"
    alert_window_seconds: int = 300
    alert_threshold: int = 5
    poll_seconds: int = 60


DEFAULT = Settings()
