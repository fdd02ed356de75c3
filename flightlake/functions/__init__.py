from .aggregates import count_when, first_by, rate, rows, true_count
from .parse import (flag, hhmm_hour, is_delayed, minutes, month_of, obs_timestamp,
                    station_code, visibility, year_of)

__all__ = [
    "count_when", "first_by", "rate", "rows", "true_count",
    "flag", "hhmm_hour", "is_delayed", "minutes", "month_of", "obs_timestamp",
    "station_code", "visibility", "year_of",
]
