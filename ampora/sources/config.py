"""Configuration lists (metric labels, metric -> weather relationship).

They are short fixed lists, so operators turn them into literal map expressions:
no join, and an aggregate above the lookup still combines directly on the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampora.constants import METRIC_LABELS_EN, RELATIONSHIPS, WEATHER_LABELS_ES

Relationship = tuple[str, str, str, str, bool]


def relationship_rows(rows: list[Relationship] | None = None, language: str = "en") -> list[Relationship]:
    """(metric_type, relationship_group, weather_column, weather_label, show_scatter).
    For the built-in list ``language`` picks the weather label; custom ``rows`` carry their own."""
    if rows is not None:
        return list(rows)
    if language == "es":
        es = dict(WEATHER_LABELS_ES)
        return [(m, g, c, es[m], sc) for m, g, c, _, sc in RELATIONSHIPS]
    return list(RELATIONSHIPS)


def label_rows(rows: list[tuple[str, str]] | None = None, language: str = "en") -> list[tuple[str, str]]:
    """(metric_type, label).  Spanish labels are the metric names."""
    if rows is not None:
        return list(rows)
    return list(METRIC_LABELS_EN) if language == "en" else [(m, m) for m, _ in METRIC_LABELS_EN]


def lookup(key: Column, pairs: list[tuple[str, object]]) -> Column:
    """Value of ``key`` in a fixed list; NULL if absent or if the key is NULL."""
    if not pairs:
        return F.lit(None)
    table = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    return F.try_element_at(table, key)
