"""All thresholds of the transit operators, as arguments. Defaults are fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Settings:
    """Defaults suit feeds polled every half to one minute; ``coarse()`` suits tables with hours between observations."""

    zone: str = "America/New_York"
    # observations and arrivals
    min_epoch: int = 1_000_000_000
    max_bracket_sec: int = 180
    overhang_hours: int = 4
    trip_keys: tuple[str, ...] = ("trip_id",)
    non_revenue_route: str = "NR"
    # quality
    expected_per_hour: int = 60
    short_hour_tolerance: float = 0.9
    min_match_rate: float = 0.95
    max_implausible_rate: float = 0.05
    max_duration_sec: int = 3600
    max_duration_ratio: int = 10
    # features
    rolling_traversals: int = 5
    rolling_max_age_sec: int = 3600
    max_headway_sec: int = 3600
    implausible_schedule_sec: int = 900
    # which flags a segment must pass, and which groups of features are made
    plausible_only: bool = True
    confident_only: bool = True
    observed_only: bool = False
    calendar_features: bool = True
    schedule_features: bool = True
    identity_features: bool = True
    historical_features: bool = True
    fare_evening_hour: float = 21.5
    # splits and journeys
    validation_fraction: float = 0.2
    embargo_sec: int = 3600
    min_days: int = 14
    lengths: tuple[int, ...] = (1, 2, 3, 4, 6, 8, 10, 12, 14, 17)
    block_tolerance_sec: int = 1
    measurement_floor_sec: float = 24.0
    max_trained_segments: int = 17
    # catching up
    lookback_days: int = 14
    staging_retention_days: int = 7

    def coarse(self) -> Settings:
        day = 86_400
        return replace(self, max_bracket_sec=day // 2, max_duration_sec=30 * day, rolling_max_age_sec=7 * day, max_headway_sec=day, embargo_sec=day, lengths=(1, 2, 3, 4), max_duration_ratio=400)


DEFAULT = Settings()
COARSE = DEFAULT.coarse()

#: One run of a trip on a service day.
TRIP_KEY = ("service_date", "trip_id", "trip_run")
#: One stretch between two stops.
SEGMENT_KEY = ("from_stop_id", "to_stop_id")
