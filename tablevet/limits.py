"""Thresholds of the integrity gates and of the task rules."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Limits:
    """All limits are inclusive; ``None`` for a maximum means there is none."""

    # The default screening limits.
    min_rows: int = 500
    max_rows: int | None = 10_000
    min_features: int = 5
    max_features: int | None = 100
    max_classes: int = 20
    min_class_size: int = 5
    min_target_repeat: int = 2
    max_missing_share: float = 0.5
    int_class_values: int = 15
    int_class_share: float = 0.05
