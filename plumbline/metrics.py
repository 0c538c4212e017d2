"""Metrics as data: what a metric is called, how it reads, where it is found."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from plumbline import rules

# Fixed patterns of the three things a ``near`` spec can take.
TAKES = {
    "first_percent": r"([0-9]{1,3}(?:\.[0-9]{1,4})?)\s*%",
    "first_number": r"([0-9][0-9,]*(?:\.[0-9]+)?)",
    "first_basis_points": r"([0-9]{2,4})\s*basis points",
}


@dataclass(frozen=True)
class MetricSpec:
    key: str
    label: str = ""
    unit: str = "pct"
    direction: int = 0
    low: float = -1e9
    high: float = 1e9
    preferences: tuple[tuple[str, str], ...] = ()
    entity_types: tuple[str, ...] = ()
    custom: bool = False
    # Where prose states it: either anchors with explicit patterns, or phrases
    # to look beside, what to take, and how far to look.
    anchors: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    near: tuple[str, ...] = ()
    take: str = "first_percent"
    within: int = 300
    # Label pattern of a highlights-table row that states it.
    highlight_rows: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.unit not in rules.METRIC_UNITS:
            raise ValueError(f"metric {self.key!r}: unknown unit {self.unit!r}")
        if self.direction not in (-1, 0, 1):
            raise ValueError(f"metric {self.key!r}: direction must be -1, 0 or 1")
        if not self.low < self.high:
            raise ValueError(f"metric {self.key!r}: range needs low < high")
        if self.near and self.patterns:
            raise ValueError(f"metric {self.key!r}: give near or patterns, not both")
        if self.near and self.take not in TAKES:
            raise ValueError(f"metric {self.key!r}: unknown take {self.take!r}")
        if self.near and not 10 <= self.within <= 2000:
            raise ValueError(f"metric {self.key!r}: within must be 10 to 2000 characters")

    def search_phrases(self) -> tuple[str, ...]:
        return self.near or self.anchors or (self.label.lower(),)

    def search_patterns(self) -> tuple[str, ...]:
        """Patterns whose first group is the value."""
        if not self.near:
            return self.patterns
        gap = r"[^.]{0,%d}?" % self.within
        return tuple(re.escape(phrase) + gap + TAKES[self.take] for phrase in self.near)


def unique(specs: Sequence[MetricSpec]) -> tuple[MetricSpec, ...]:
    keys = [s.key for s in specs]
    repeated = sorted({k for k in keys if keys.count(k) > 1})
    if repeated:
        raise ValueError(f"metric keys defined twice: {repeated}")
    return tuple(specs)


BUILTIN = unique([
    MetricSpec(key, label, unit, direction, low, high, rules.BASIS_PREFERENCE.get(key, ()))
    for key, label, unit, direction, low, high in rules.BUILTIN_METRICS
])

_FRAME = T.StructType([
    T.StructField("metric", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("direction", T.IntegerType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("custom", T.BooleanType()),
    T.StructField("entity_types", T.ArrayType(T.StringType())),
    T.StructField("preferences", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()), T.StructField("val", T.StringType()),
    ]))),
])


def metric_frame(spark: SparkSession, specs: Sequence[MetricSpec]) -> DataFrame:
    """The registry as a dimension table; one row per metric, so it is broadcast."""
    rows = [
        (s.key, s.label, s.unit, s.direction, float(s.low), float(s.high), s.custom,
         list(s.entity_types), [tuple(p) for p in s.preferences])
        for s in unique(specs)
    ]
    return spark.createDataFrame(rows, _FRAME)


def spec_table(spark: SparkSession, specs: Sequence[MetricSpec]) -> DataFrame:
    """Where prose states metrics, as rows: phrases to stop at and patterns tried in order."""
    rows = [
        (s.key, s.unit, float(s.low), float(s.high), list(s.entity_types), list(s.search_phrases()), list(s.search_patterns()))
        for s in unique(specs)
    ]
    return spark.createDataFrame(
        rows, "metric string, unit string, low double, high double, entity_types array<string>, "
              "phrases array<string>, patterns array<string>")
