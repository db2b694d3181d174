"""Names for ranges of a total severity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive lower bound, upper bound, level name.
SEVERITY_LEVELS = (
    (-10, -3, "highly frustrated"),
    (-2, -1, "low frustrated"),
    (0, 0, "neutral"),
    (1, 2, "happy"),
    (3, 10, "overwhelming"),
)
OTHER_LEVEL = "unknown"


def bucket(value: Column, ranges, other: str) -> Column:
    """Name of the first inclusive range that holds ``value``, else ``other``."""
    labelled = None
    for low, high, name in ranges:
        test = value.between(low, high)
        labelled = F.when(test, name) if labelled is None else labelled.when(test, name)
    return labelled.otherwise(other)


def frustration_level(total_severity: Column) -> Column:
    return bucket(total_severity, SEVERITY_LEVELS, OTHER_LEVEL)
