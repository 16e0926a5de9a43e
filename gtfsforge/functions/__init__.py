"""Column-level functions: clock times, RD->WGS84, composite ids, first-per-key."""

from .cols import as_col, pipe_id, null_of, ensure_columns
from .first import first_per_key, nulls_last
from .geo import rd_to_wgs84, rd_lat, rd_lon
from .times import (
    to_seconds, hhmm_to_seconds, format_clock, add_seconds_to_clock, timediff,
    pad_seconds, parse_ddmmyyyy, gtfs_date, weekday_mon1, weekday_sun1,
)

__all__ = [
    "as_col", "pipe_id", "null_of", "ensure_columns", "first_per_key", "nulls_last",
    "rd_to_wgs84", "rd_lat", "rd_lon", "to_seconds", "hhmm_to_seconds", "format_clock",
    "add_seconds_to_clock", "timediff", "pad_seconds", "parse_ddmmyyyy", "gtfs_date",
    "weekday_mon1", "weekday_sun1",
]
