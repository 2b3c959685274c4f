"""Join helper: orphan detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]] | Column) -> DataFrame:
    """Rows of ``child`` with no match in ``parent`` (``LEFT JOIN ... IS NULL`` as an anti join)."""
    if isinstance(on, Column):
        cond = on
    else:
        cond = None
        for ck, pk in on:
            e = child[ck] == parent[pk]
            cond = e if cond is None else cond & e
    return child.join(parent, cond, "left_anti")
