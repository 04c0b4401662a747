from storelens.functions.columns import (
    MONEY, average, cents, money, outcome_of_service, ratio, rate, rounded, span_days,
)

__all__ = [
    "MONEY", "average", "cents", "money", "outcome_of_service", "ratio", "rate", "rounded", "span_days",
]
