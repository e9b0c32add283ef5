from orderlens.functions.columns import (
    MICROSECONDS_AN_HOUR,
    epoch_seconds,
    hours_between,
    is_delivered,
    microseconds_between,
    order_value,
    ratio,
    stamp,
    stockout_flag,
)

__all__ = [
    "MICROSECONDS_AN_HOUR",
    "epoch_seconds",
    "hours_between",
    "is_delivered",
    "microseconds_between",
    "order_value",
    "ratio",
    "stamp",
    "stockout_flag",
]
