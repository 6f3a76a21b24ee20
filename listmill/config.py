"""Settings that change what a run keeps."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class EngineConfig:
    window_start: dt.date = dt.date(2026, 10, 1)
    window_end: dt.date = dt.date(2027, 3, 31)
    scope_continents: tuple[str, ...] = ("Asia",)
    public_continents: tuple[str, ...] = ("Asia", "Europe")
    cache_ttl_hours: int = 72
    detail_cache_days: int = 7
    page_max_age_days: int = 365
    max_input_chars: int = 48000
    max_pages_per_site: int = 8
    today: dt.date = field(default_factory=dt.date.today)
