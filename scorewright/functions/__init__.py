"""Column expressions shared by the operators. All are built-in Spark functions, so they stay in codegen."""

from scorewright.functions.exprs import (  # noqa: F401
    as_date,
    category_text,
    decile,
    flag,
    hist_bin,
    parse_yyyymmdd,
    psi_band,
    psi_bin,
    risk_tier,
    round_half_even,
)
