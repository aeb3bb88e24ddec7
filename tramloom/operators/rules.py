"""What can be wrong with a segment: one table that counts, flags and filters are all taken from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramloom.config import Settings
from tramloom.operators.arrivals import PREDICTED


@dataclass(frozen=True)
class Rule:
    """``broken`` says which segments break the rule; ``drops`` under which settings these are unfit for features."""

    name: str
    broken: Callable[[Settings], Column]
    impossible: bool = False
    drops: Callable[[Settings], bool] = lambda settings: False
    reason: str | None = None


def _over_ratio(settings: Settings) -> Column:
    planned = F.col("scheduled_duration_sec")
    return (planned > 0) & (F.col("actual_duration_sec") > planned * settings.max_duration_ratio)


#: Names are fixed: quality reports publish them. The first four are in the order in which filters act, as what is
#: dropped counts under the first rule that it breaks; then what can't be, then what is only worth knowing.
RULES = (
    Rule("implausible", lambda s: ~F.col("duration_plausible"), drops=lambda s: s.plausible_only, reason="duration_plausible"),
    Rule("low_confidence", lambda s: ~F.col("arrival_confident"), drops=lambda s: s.confident_only, reason="arrival_confident"),
    Rule("from_predictions", lambda s: F.col("arrival_source") == PREDICTED, drops=lambda s: s.observed_only, reason="observed"),
    Rule("missing_schedule", lambda s: F.col("scheduled_duration_sec").isNull(), drops=lambda s: True, reason="scheduled"),
    Rule("ratio_outliers", _over_ratio, impossible=True),
    Rule("implausibly_long", lambda s: F.col("actual_duration_sec") > s.max_duration_sec, impossible=True),
    Rule("negative_duration", lambda s: F.col("actual_duration_sec") < 0, impossible=True),
    Rule("repeat_run_rows", lambda s: F.col("trip_run") > 0),
    Rule("stale_schedule_version", lambda s: ~F.col("schedule_version_agrees")),
    Rule("sequence_gaps", lambda s: F.col("stop_span") > 1),
)


def first_reason(settings: Settings) -> Column:
    """Why a segment is unfit for features; null if it is fit."""
    return F.coalesce(*[F.when(rule.broken(settings), F.lit(rule.reason)) for rule in RULES if rule.drops(settings)], F.lit(None).cast("string"))


def tally(settings: Settings) -> dict[str, Column]:
    """How many segments break each rule, as aggregates by name."""
    return {rule.name: F.count_if(rule.broken(settings)).cast("long") for rule in RULES}
