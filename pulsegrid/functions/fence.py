"""Projection fence: stop Catalyst from inlining expensive projections into
pushed-down predicates.

Filter pushdown through a Project substitutes every alias by its
expression. When a predicate references columns derived from an expensive
expression (a JSON parse, a regex), the expression is copied into the filter
and evaluated once per copy, before any rebalancing exchange. Re-emitting
the columns through a one-element ``inline`` generator keeps later
predicates above it, so each expression is evaluated once per row. The
generator is whole-stage-codegen'd.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame, cols: list[Column] | None = None) -> DataFrame:
    """``df.select(*cols)`` (default: all columns) behind a generator."""
    cols = cols if cols is not None else [F.col(c) for c in df.columns]
    return df.select(F.inline(F.array(F.struct(*cols))))
