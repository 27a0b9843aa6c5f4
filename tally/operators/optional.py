"""Optional report filters (the BI tool's ``[[ and col = {{p}} ]]`` blocks).

A filter whose parameter is not given vanishes; a given one is an ordinary
predicate that Catalyst pushes as far down as it can.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import Column, DataFrame


def optional_filters(df: DataFrame,
                     rules: Iterable[tuple[Any, Callable[[Any], Column]]]) -> DataFrame:
    """Apply ``make(value)`` for every ``(value, make)`` whose value is not None."""
    for value, make in rules:
        if value is not None:
            df = df.filter(make(value))
    return df
