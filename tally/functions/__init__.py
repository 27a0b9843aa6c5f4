"""Column helpers with Postgres semantics, built only from Spark built-ins."""

from tally.functions.money import clamp0, dollars, round2
from tally.functions.text import addr5, brand_key, pg_concat
from tally.functions.time import (
    from_ny_wall,
    ny_date,
    ny_date_between,
    ny_midnight_utc,
    ntz_lit,
    ny_wall_before,
    pg_to_char,
    report_timestamp_text,
    spark_pattern,
    to_ny_wall,
)

__all__ = [
    "addr5", "brand_key", "clamp0", "dollars", "from_ny_wall", "ntz_lit", "ny_date",
    "ny_date_between", "ny_midnight_utc", "ny_wall_before", "pg_concat", "pg_to_char",
    "report_timestamp_text", "round2", "spark_pattern", "to_ny_wall",
]
