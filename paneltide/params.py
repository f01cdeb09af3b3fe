"""Run parameters. Defaults are the reference's values; ``TEST_PARAMS`` maps
them onto the driver tables (orders/lineitem span 1995-2001)."""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from paneltide.functions import constants as K


def _now() -> dt.datetime:
    """Current UTC time without a zone (the session's time zone is UTC)."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Params:
    year_min: int = K.YEAR_MIN_DEFAULT          # staging BETWEEN lower bound
    year_max: int = K.YEAR_MAX_DEFAULT          # staging BETWEEN upper bound
    score_year_min: int = K.YEAR_MIN_DEFAULT    # composite index lower bound
    api_start: int = 2000                       # read-API default year range
    api_end: int = 2023
    countries: tuple[str, ...] | None = tuple(K.SCOPE_COUNTRIES)
    # stamps of a run: the run's own start unless given
    load_date: dt.date = field(default_factory=lambda: _now().date())
    detected_at: dt.datetime = field(default_factory=lambda: _now())
    processed_at: dt.datetime = field(default_factory=lambda: _now())
    reload_date: dt.date = dt.date(2024, 1, 1)  # older second load (dedupe input)
    reload_factor: float = 0.99
    z_threshold: float = K.ZSCORE_THRESHOLD
    top_k: int = K.TOP_ANOMALIES_PER_TABLE
    recent_alerts: int = K.RECENT_ALERTS_LIMIT
    dedupe_inflation: bool = True
    ingestion_events: tuple[str, ...] = ("gdp_annual", K.FULL_PIPELINE_EVENT, "unknown")

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


TEST_PARAMS = Params(year_min=1995, year_max=2030, score_year_min=1995,
                     api_start=1995, api_end=2023, load_date=dt.date(2024, 1, 2),
                     detected_at=dt.datetime(2024, 1, 2), processed_at=dt.datetime(2024, 1, 2))
