"""Column expressions without state."""

from gablework.functions.expressions import (  # noqa: F401
    adjusted_skew,
    differs,
    fold_of,
    guarded_corr,
    log1p_or_null,
    normal_quantile,
    present,
    price_error,
    uniform_hash,
    weighted_sum,
)
