"""Sort keys that put NULL last, as the source database does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(*columns: Column | str) -> Column:
    """Struct for ``min_by``: smallest first, NULL after every value."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.struct(*[x for i, c in enumerate(parts) for x in (c.isNull().alias(f"n{i}"), c.alias(f"v{i}"))])


def newest_key(*columns: Column | str) -> Column:
    """Struct for ``max_by``: largest first, NULL after every value."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.struct(*[x for i, c in enumerate(parts) for x in (c.isNotNull().alias(f"n{i}"), c.alias(f"v{i}"))])


def nulls_last(columns: list[Column | str]) -> list[Column]:
    """Ascending order with NULL at the end; columns that carry their own order stay."""
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in columns]


def same(left, right, columns: list[str]) -> Column:
    """Join condition on equal columns, NULL equal to NULL."""
    out = F.lit(True)
    for c in columns:
        out = out & left[c].eqNullSafe(right[c])
    return out
