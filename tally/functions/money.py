"""Money columns.

Amounts are held in integer (or decimal) cents and are only turned into
dollars at the edge, exactly, through decimal arithmetic. Sums are taken over
cents, so no floating point error is ever summed.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_ONE_CENT = Decimal("0.01")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dollars(cents: Column | str, as_double: bool = True) -> Column:
    """``cents / 100`` computed exactly (decimal multiply), optionally as double.

    The double is the nearest double to the exact dollar value, the same value
    ``cents::double / 100`` gives in any IEEE engine.
    """
    value = _col(cents) * F.lit(_ONE_CENT)
    return value.cast("double") if as_double else value


def clamp0(c: Column | str) -> Column:
    """``greatest(c, 0)``: NULL is skipped, so a NULL input gives 0."""
    return F.greatest(_col(c), F.lit(0))


def round2(c: Column | str) -> Column:
    """``round(c, 2)``, half away from zero on decimals."""
    return F.round(_col(c), 2)
