"""Column-expression builders: encoders, one-hot, imputation, scaling, SQL functions."""

from percepta.functions.encode import encode, encode_values, guard_null, one_hot
from percepta.functions.scale import (
    impute,
    min_max_scale,
    scale_value_literal,
    standardize,
)
from percepta.functions.sqlfuncs import register_encoder, register_filler, register_functions

__all__ = [
    "encode",
    "encode_values",
    "guard_null",
    "impute",
    "min_max_scale",
    "one_hot",
    "register_encoder",
    "register_filler",
    "register_functions",
    "scale_value_literal",
    "standardize",
]
