"""Rows handed through an operator whole, whatever their columns are called."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.schema import quoted


def whole_row(df: DataFrame) -> Column:
    """All columns of `df` as one struct, beside which an operator can name its own columns freely."""
    return F.struct(*[df[quoted(c)].alias(c) for c in df.columns])


def unwrapped(df: DataFrame, columns: list[str], row: str = "row") -> DataFrame:
    """The columns of the struct `row` again."""
    return df.select(*[df[row][c].alias(c) for c in columns])
