"""Ordered first-match rules as data, compiled into one CASE WHEN column.

Rules are plain data so a deployment can swap them (for example a finer
region table) without touching the jobs. Each rule list compiles to a single
SQL ``CASE WHEN`` expression (one parse instead of one driver round trip per
comparison), so classification stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quartermart.functions import constants as K


def first_match(rules: Sequence[tuple[Column, str]], default: str | None) -> Column:
    """``CASE WHEN c1 THEN l1 WHEN c2 THEN l2 ... ELSE default END``."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def sql_string(text: str) -> str:
    """A Spark SQL string literal: backslashes and quotes backslash-escaped."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def first_match_sql(rules: Sequence[tuple[str, str]], default: str | None) -> str:
    """``CASE WHEN c1 THEN 'l1' ... ELSE 'default' END`` from SQL conditions."""
    if not rules:
        return "NULL" if default is None else sql_string(default)
    body = " ".join(f"WHEN {cond} THEN {sql_string(label)}" for cond, label in rules)
    tail = "" if default is None else f" ELSE {sql_string(default)}"
    return f"CASE {body}{tail} END"


@dataclass(frozen=True)
class Box:
    """Axis-aligned region rule; ``None`` bounds are open."""

    label: str
    lat_min: float | None = None      # lat >= lat_min
    lat_below: float | None = None    # lat <  lat_below
    lat_at_most: float | None = None  # lat <= lat_at_most
    lon_min: float | None = None      # lon >= lon_min
    lon_below: float | None = None    # lon <  lon_below

    def condition(self, lat: Column, lon: Column) -> Column:
        parts = []
        if self.lat_min is not None:
            parts.append(lat >= self.lat_min)
        if self.lat_below is not None:
            parts.append(lat < self.lat_below)
        if self.lat_at_most is not None:
            parts.append(lat <= self.lat_at_most)
        if self.lon_min is not None:
            parts.append(lon >= self.lon_min)
        if self.lon_below is not None:
            parts.append(lon < self.lon_below)
        cond = F.lit(True)
        for p in parts:
            cond = cond & p
        return cond

    def sql_condition(self, lat: str, lon: str) -> str:
        parts = []
        if self.lat_min is not None:
            parts.append(f"{lat} >= {self.lat_min!r}")
        if self.lat_below is not None:
            parts.append(f"{lat} < {self.lat_below!r}")
        if self.lat_at_most is not None:
            parts.append(f"{lat} <= {self.lat_at_most!r}")
        if self.lon_min is not None:
            parts.append(f"{lon} >= {self.lon_min!r}")
        if self.lon_below is not None:
            parts.append(f"{lon} < {self.lon_below!r}")
        return " AND ".join(parts) if parts else "TRUE"


@dataclass(frozen=True)
class RegionRules:
    boxes: tuple[Box, ...]
    default: str

    @property
    def labels(self) -> list[str]:
        return [b.label for b in self.boxes] + [self.default]

    def column(self, lat: str | Column = "latitude", lon: str | Column = "longitude") -> Column:
        if isinstance(lat, str) and isinstance(lon, str):
            return F.expr(first_match_sql([(b.sql_condition(f"`{lat}`", f"`{lon}`"), b.label)
                                           for b in self.boxes], self.default))
        lat_c = F.col(lat) if isinstance(lat, str) else lat
        lon_c = F.col(lon) if isinstance(lon, str) else lon
        return first_match([(b.condition(lat_c, lon_c), b.label) for b in self.boxes], self.default)


@dataclass(frozen=True)
class CategoryRules:
    """Regex rules in order, then ``label == no_label -> unclassified``, else default."""

    patterns: tuple[tuple[str, str], ...]
    no_label: str = K.NO_LABEL
    unclassified: str = K.UNCLASSIFIED
    default: str = K.OTHER_CATEGORY

    @property
    def labels(self) -> list[str]:
        return [label for label, _ in self.patterns] + [self.unclassified, self.default]

    def column(self, label_text: str | Column = "label_zh") -> Column:
        if isinstance(label_text, str):
            col = f"`{label_text}`"
            rules = [(f"{col} RLIKE {sql_string(rx)}", label) for label, rx in self.patterns]
            rules.append((f"{col} = {sql_string(self.no_label)}", self.unclassified))
            return F.expr(first_match_sql(rules, self.default))
        text = label_text
        rules = [(text.rlike(rx), label) for label, rx in self.patterns]
        rules.append((text == F.lit(self.no_label), self.unclassified))
        return first_match(rules, self.default)


DEFAULT_REGION_RULES = RegionRules(
    boxes=tuple(Box(label, a_min, a_below, a_most, o_min, o_below)
                for label, a_min, a_below, a_most, o_min, o_below in K.REGION_BOXES),
    default=K.REGION_SOUTHWEST,
)

DEFAULT_CATEGORY_RULES = CategoryRules(patterns=tuple(K.CATEGORY_PATTERNS))
