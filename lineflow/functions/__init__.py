"""Record functions: built-in steps and table functions."""

from lineflow.functions.steps import (
    dataframe_step,
    drop_if,
    filter_step,
    flat_step,
    from_json,
    identity,
    interpolate,
    keep_if,
    map_step,
    repeat,
    route,
    skip,
    to_json,
    tokenize,
    upcase,
)
from lineflow.functions.udtf import PrimeFactors, factorize, register_udtfs, with_prime_factors

__all__ = ["dataframe_step", "drop_if", "filter_step", "flat_step", "from_json", "identity", "interpolate", "keep_if", "map_step",
           "repeat", "route", "skip", "to_json", "tokenize", "upcase", "PrimeFactors", "factorize", "register_udtfs",
           "with_prime_factors"]
