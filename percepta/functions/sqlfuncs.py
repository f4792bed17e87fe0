"""Named SQL functions for the encoders and imputers.

The original code registers Java UDFs by name and calls them with
``callUDF``. Here the same names are SQL functions
(``CREATE TEMPORARY FUNCTION ... RETURN <expr>``): Catalyst inlines their
bodies, so they stay inside whole-stage codegen and need no Python worker.
Call them from SQL or with ``F.call_function(name, col)``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from percepta.spec import Encoding, FeatureSpec


def sql_string(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_double(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def encoding_sql(arg: str, enc: Encoding) -> str:
    null_code = "NULL" if enc.null_as is None else str(int(enc.null_as))
    parts = [f"CASE WHEN {arg} IS NULL THEN {null_code}"]
    for value, code in enc.mapping:
        parts.append(f"WHEN {arg} = {sql_string(value)} THEN {int(code)}")
    parts.append(f"ELSE {int(enc.other)} END")
    return " ".join(parts)


def encoder_name(column: str) -> str:
    return f"encode_{column.lower()}"


def filler_name(column: str) -> str:
    return f"fill_{column.lower()}"


def register_encoder(spark: SparkSession, name: str, enc: Encoding) -> str:
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS INT "
        f"RETURN {encoding_sql('x', enc)}"
    )
    return name


def register_filler(spark: SparkSession, name: str, value: float) -> str:
    """A fill function with the value baked in as a literal (closure -> constant)."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x DOUBLE) RETURNS DOUBLE "
        f"RETURN coalesce(x, {sql_double(value)})"
    )
    return name


def register_functions(
    spark: SparkSession,
    spec: FeatureSpec,
    fill_values: Mapping[str, float] | None = None,
    prefix: str = "",
) -> dict[str, dict[str, str]]:
    """Register one encoder per encoded categorical and one filler per given value.

    ``prefix`` keeps the functions of two fitted frames apart in one session.
    Returns ``{"encode": {column: name}, "fill": {column: name}}``.
    """
    encoders = {
        cat.column: register_encoder(spark, prefix + encoder_name(cat.column), cat.encoding)
        for cat in spec.categorical
        if cat.encoding is not None
    }
    fillers = {
        column: register_filler(spark, prefix + filler_name(column), value)
        for column, value in (fill_values or {}).items()
    }
    return {"encode": encoders, "fill": fillers}
