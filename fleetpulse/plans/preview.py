"""A short look at a result."""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 5, order_cols: list[str] | None = None, show: bool = True):
    """The first ``n`` rows, printed unless ``show`` is off. Ordered if columns are given."""
    head = (df.orderBy(*order_cols) if order_cols else df).limit(n)
    if show:
        head.show(n, truncate=False)
    return head
