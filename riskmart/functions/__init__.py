from riskmart.functions.expr import (  # noqa: F401
    dec_avg,
    dec_sum,
    flag,
    from_units,
    int_avg,
    lit_date,
    model,
    pct,
    register_sql_functions,
    rnd,
    round_half_away,
    safe_div,
    sum_flag,
    to_units,
    units_sum,
    wide_sum,
)
