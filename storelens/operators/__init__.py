from storelens.operators.calendar import date_dim, fill_days
from storelens.operators.forecast import demand_forecast
from storelens.operators.ranks import percentiles, rows_at_ranks, tiles
from storelens.operators.sequence import next_in_group
from storelens.operators.significance import p_value, pooled_error, two_proportion_test

__all__ = [
    "date_dim", "demand_forecast", "fill_days", "next_in_group", "p_value",
    "percentiles", "pooled_error", "rows_at_ranks", "tiles", "two_proportion_test",
]
