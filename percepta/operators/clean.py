"""Projection, casts, constant fill, drop, rename, null-row inspection.

All narrow transformations: each is a single projection or filter that
Catalyst collapses into the scan's stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.select(*cols)


def cast_columns(
    df: DataFrame, casts: Mapping[str, str], keep_others: bool = False, safe: bool = True
) -> DataFrame:
    """Cast the named columns; by default only they are kept, in the given order.

    ``safe=True`` uses ``try_cast``: an unparsable or overflowing value becomes
    NULL (what the old non-ANSI cast did) instead of failing the query.
    Casting a double to an integer type truncates toward zero.
    """
    def cast(name: str, type_name: str) -> Column:
        c = F.col(name)
        return (c.try_cast(type_name) if safe else c.cast(type_name)).alias(name)

    if keep_others:
        return df.withColumns({n: cast(n, t) for n, t in casts.items()})
    return df.select(*[cast(n, t) for n, t in casts.items()])


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """``na.fill`` by column: NULLs of each named column get its constant.

    A fractional constant filled into an integer column is truncated, and a
    numeric constant is ignored for string columns (``na.fill`` semantics).
    """
    return df.na.fill(dict(values))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by name; names not in the frame are ignored."""
    return df.drop(*names)


def rename_columns(df: DataFrame, names: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Rename all columns by position (a sequence) or some by name (a mapping)."""
    if isinstance(names, Mapping):
        return df.withColumnsRenamed(dict(names))
    return df.toDF(*names)


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())
