"""New York calendar helpers and Postgres ``to_char`` patterns.

Convention: every instant is stored as a UTC ``timestamp_ntz`` and the session
time zone is UTC. "NY wall time" is the local clock reading in New York for
such an instant.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"
_UTC = dt.timezone.utc


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ny_wall(instant: Column | str) -> Column:
    """``timezone('America/New_York', timestamptz)``: UTC instant -> NY wall time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(NEW_YORK),
                              _col(instant).cast("timestamp_ntz"))


def from_ny_wall(wall: Column | str) -> Column:
    """``timezone('America/New_York', timestamp)``: NY wall time -> UTC instant."""
    return F.convert_timezone(F.lit(NEW_YORK), F.lit("UTC"),
                              _col(wall).cast("timestamp_ntz"))


def ny_date(instant: Column | str) -> Column:
    """Calendar date in New York of a UTC instant."""
    return F.to_date(to_ny_wall(instant))


def ntz_lit(value: dt.date | dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal (a date means its midnight).

    Built from ISO text so that the driver's own time zone never shifts it;
    Catalyst folds the cast, so comparisons against it reach the scan.
    """
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def ny_midnight_utc(day: dt.date) -> dt.datetime:
    """UTC instant (naive) of midnight in New York on ``day``.

    Used for filters the parquet scan can evaluate: for any instant ``t``,
    ``to_ny_wall(t) < day 00:00`` holds exactly when ``t < ny_midnight_utc(day)``,
    because New York never moves its clocks across midnight.
    """
    local = dt.datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(NEW_YORK))
    return local.astimezone(_UTC).replace(tzinfo=None)


def ny_wall_before(instant: Column | str, day: dt.date, inclusive: bool = False) -> Column:
    """``to_ny_wall(instant) < day 00:00`` (or ``<=``), as a plain UTC comparison.

    Exact by ``ny_midnight_utc``; a comparison with a literal is pushed into
    the parquet scan and costs no per-row time-zone conversion.
    """
    bound = ntz_lit(ny_midnight_utc(day))
    c = _col(instant)
    return c <= bound if inclusive else c < bound


def ny_date_between(instant: Column | str, start: dt.date, end: dt.date) -> Column:
    """``ny_date(instant) BETWEEN start AND end`` as UTC bounds (see above)."""
    c = _col(instant)
    return ((c >= ntz_lit(ny_midnight_utc(start)))
            & (c < ntz_lit(ny_midnight_utc(end + dt.timedelta(days=1)))))


# Postgres to_char template tokens and the Spark datetime
# pattern letters with the same output. Postgres matches these tokens in
# either case; longest token first.
_PG_TOKENS = [
    ("HH24", "HH"),
    ("HH12", "hh"),
    ("YYYY", "yyyy"),
    ("HH", "hh"),
    ("MM", "MM"),
    ("DD", "dd"),
    ("MI", "mm"),
    ("SS", "ss"),
    ("YY", "yy"),
]


def spark_pattern(pg_format: str) -> str:
    """Translate a Postgres ``to_char`` template into a Spark datetime pattern.

    Tokens are matched case-insensitively, as Postgres does for numeric
    fields, so ``mm/dd/yyyy`` is month/day/year (in Spark ``mm`` would be
    minutes) and ``HH:MM`` is a 12-hour clock followed by the *month*.
    Anything else is copied as quoted literal text.
    """
    out: list[str] = []
    literal: list[str] = []
    i = 0
    upper = pg_format.upper()
    while i < len(pg_format):
        for token, letters in _PG_TOKENS:
            if upper.startswith(token, i):
                if literal:
                    out.append("'" + "".join(literal).replace("'", "''") + "'")
                    literal = []
                out.append(letters)
                i += len(token)
                break
        else:
            literal.append(pg_format[i])
            i += 1
    if literal:
        out.append("'" + "".join(literal).replace("'", "''") + "'")
    return "".join(out)


def pg_to_char(c: Column | str, pg_format: str) -> Column:
    """``to_char(c, pg_format)`` with Postgres template semantics."""
    return F.date_format(_col(c), spark_pattern(pg_format))


def report_timestamp_text(generated_at: dt.datetime, legacy_format: bool = False) -> Column:
    """The ``report_generated_at`` column.

    The reports print ``to_char(now(), 'MM/DD/YYYY HH:MM')``, whose second
    ``MM`` is the month, not the minute. ``legacy_format=True`` reproduces that
    text; the default prints hour and minute.
    """
    fmt = "MM/DD/YYYY HH:MM" if legacy_format else "MM/DD/YYYY HH24:MI"
    return F.date_format(ntz_lit(generated_at), spark_pattern(fmt))
