"""DataFrame -> DataFrame operators."""

from strata.operators.aggregate import ROLLUP_MODES, annual_sum, rollup_sum
from strata.operators.cleaning import range_filter, split_valid, tag_valid
from strata.operators.join import allocate, outer_balance
from strata.operators.quality import (
    Check,
    QualityCheckFailed,
    assert_checks,
    assert_details,
    count_rows,
    count_where,
    evaluate,
    evaluate_observation,
    load_named_checks,
    parse_named_checks,
    null_rate,
    observe_checks,
    run_checks,
    run_sql_checks,
    run_suite,
)
from strata.operators.window import (
    top_n,
    with_cumulative,
    with_prev,
    with_prev_period,
    with_rank,
    with_share,
    with_trend,
    with_yoy,
)

__all__ = [
    "ROLLUP_MODES",
    "Check",
    "QualityCheckFailed",
    "allocate",
    "annual_sum",
    "assert_checks",
    "assert_details",
    "count_rows",
    "count_where",
    "evaluate",
    "evaluate_observation",
    "load_named_checks",
    "parse_named_checks",
    "null_rate",
    "observe_checks",
    "outer_balance",
    "range_filter",
    "rollup_sum",
    "run_checks",
    "run_sql_checks",
    "run_suite",
    "split_valid",
    "tag_valid",
    "top_n",
    "with_cumulative",
    "with_prev",
    "with_prev_period",
    "with_rank",
    "with_share",
    "with_trend",
    "with_yoy",
]
