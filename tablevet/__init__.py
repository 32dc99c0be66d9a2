"""Screening of fleets of tabular datasets as Spark jobs."""

from tablevet.limits import Limits
from tablevet.sources.fleet import Fleet, to_fleet

__all__ = ["Fleet", "Limits", "to_fleet"]
