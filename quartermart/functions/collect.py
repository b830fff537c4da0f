"""Array and map columns: sorted sets, count maps, keys with the largest value.

Every collection the warehouse emits is sorted, so results do not depend on
partitioning or task order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def top_keys(map_col: str | Column) -> Column:
    """All keys whose value is the largest in the map (ties kept), ascending.

    Empty map -> empty array; null map -> null.
    """
    m = _c(map_col)
    best = F.array_max(F.map_values(m))
    return F.sort_array(F.transform(F.filter(F.map_entries(m), lambda e: e["value"] == best),
                                    lambda e: e["key"]))


def keys_with_max(entries: Column) -> Column:
    """From an array of ``struct(value, key)`` keep the keys with the largest value, ascending."""
    best = F.array_max(F.transform(entries, lambda e: e["value"]))
    return F.sort_array(F.transform(F.filter(entries, lambda e: e["value"] == best),
                                    lambda e: e["key"]))


def array_text(col: str | Column, sep: str = ",") -> Column:
    """Sorted array as one string (for comparisons and reports)."""
    return F.array_join(F.sort_array(_c(col)), sep)


def map_text(col: str | Column, sep: str = ",") -> Column:
    """Map as ``k:v`` pairs sorted by key, as one string."""
    entries = F.sort_array(F.map_entries(_c(col)))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"),
                                                                e["value"].cast("string"))), sep)
