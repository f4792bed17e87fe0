"""Category encoders as native column expressions (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from percepta.spec import Encoding


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_values(
    col: str | Column,
    mapping: Iterable[tuple[str, int]],
    other: int,
    null_as: int | None = None,
) -> Column:
    """Map values to integer codes; unmatched non-null values get ``other``.

    Exact string comparison (case-sensitive, no trim). NULL gives ``null_as``
    (NULL when ``None``).
    """
    c = _col(col)
    expr = F.when(c.isNull(), F.lit(null_as))
    for value, code in mapping:
        expr = expr.when(c == F.lit(value), F.lit(code))
    return expr.otherwise(F.lit(other)).cast("int")


def encode(col: str | Column, encoding: Encoding) -> Column:
    return encode_values(col, encoding.mapping, encoding.other, encoding.null_as)


def guard_null(code: str | Column, vector_null: int | str, name: str) -> Column:
    """What a NULL code becomes before one-hot encoding.

    int -> that code; ``"other"`` -> unchanged (falls into the last slot);
    ``"error"`` -> the query fails with a message naming the column.
    """
    c = _col(code)
    if vector_null == "other":
        return c
    if vector_null == "error":
        return F.when(
            c.isNull(), F.raise_error(F.lit(f"NULL in categorical column {name}"))
        ).otherwise(c)
    return F.coalesce(c, F.lit(int(vector_null)))


def one_hot(col: str | Column, levels: Sequence[int | float]) -> list[Column]:
    """Indicator doubles for each level plus a last slot for everything else.

    A NULL or unlisted value sets the last slot. Values compare numerically,
    so an integer column matches levels given as 1 or 1.0.
    """
    c = _col(col)
    slots = [F.when(c == F.lit(level), 1.0).otherwise(0.0) for level in levels]
    slots.append(F.when(c.isin(*levels), 0.0).otherwise(1.0))
    return slots
