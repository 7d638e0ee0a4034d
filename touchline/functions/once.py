"""Columns that are computed exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add expensive columns as generator output.

    Catalyst copies the expression behind a projected column into every filter on
    it, and from there into every further use: a parsed body or a normalised text
    would be computed again for each. It does not look into a generator, so
    ``inline`` over one struct keeps a single evaluation.
    """
    kept = [F.col(c) for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
