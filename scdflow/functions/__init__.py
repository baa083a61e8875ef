from scdflow.functions.columns import (
    date_key,
    event_time,
    margin,
    minutes_after,
    money,
    naive,
    open_end,
    surrogate_key,
)

__all__ = [
    "date_key",
    "event_time",
    "margin",
    "minutes_after",
    "money",
    "naive",
    "open_end",
    "surrogate_key",
]
