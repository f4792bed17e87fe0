"""Column moments (global aggregate: partial per partition, one tiny final merge)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _moment_input(col: str, nulls: str):
    if nulls == "zero":
        # NULL counts as 0 and still counts in N (the original statistics did this).
        return F.coalesce(F.col(col).cast("double"), F.lit(0.0))
    if nulls == "skip":
        return F.col(col).cast("double")
    raise ValueError(f"nulls must be 'zero' or 'skip', got {nulls!r}")


def moments_frame(df: DataFrame, cols: Sequence[str], nulls: str = "zero") -> DataFrame:
    """One row: ``n`` and ``<c>_mean``, ``<c>_var``, ``<c>_std`` per column.

    Mean and unbiased (n-1) variance. With ``nulls="zero"`` a NULL is read as 0
    and counted; with ``"skip"`` it is ignored. A one-row input has NULL
    variance, as in SQL.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        x = _moment_input(c, nulls)
        aggs += [
            F.avg(x).alias(f"{c}_mean"),
            F.var_samp(x).alias(f"{c}_var"),
            F.stddev_samp(x).alias(f"{c}_std"),
        ]
    return df.agg(*aggs)


@dataclass(frozen=True)
class Moments:
    count: int
    mean: dict[str, float]
    variance: dict[str, float]

    @property
    def std(self) -> dict[str, float]:
        return {c: v**0.5 for c, v in self.variance.items()}

    def to_dict(self) -> dict:
        return {"count": self.count, "mean": self.mean, "variance": self.variance}

    @staticmethod
    def from_dict(raw: dict) -> Moments:
        return Moments(int(raw["count"]), dict(raw["mean"]), dict(raw["variance"]))


def fit_moments(df: DataFrame, cols: Sequence[str], nulls: str = "zero") -> Moments:
    """Run the aggregate (one job, one row back to the driver) and keep the numbers.

    A one-row table gets variance 0 (so standardizing gives 0); an empty
    table cannot be fitted.
    """
    row = moments_frame(df, cols, nulls).first()
    n = int(row["n"])
    if n == 0:
        raise ValueError("cannot compute column moments of an empty table")
    mean, var = {}, {}
    for c in cols:
        if row[f"{c}_mean"] is None:
            raise ValueError(f"column {c} has no non-null values")
        mean[c] = float(row[f"{c}_mean"])
        v = row[f"{c}_var"]
        var[c] = 0.0 if v is None else float(v)
    return Moments(n, mean, var)
