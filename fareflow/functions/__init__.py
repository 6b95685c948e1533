from .cleaning import sanitize_numeric
from .metrics import revenue_fields, trip_metrics
from .times import local_now, local_time, parse_trip_time, run_id, trip_times

__all__ = [
    "local_now",
    "local_time",
    "parse_trip_time",
    "revenue_fields",
    "run_id",
    "sanitize_numeric",
    "trip_metrics",
    "trip_times",
]
