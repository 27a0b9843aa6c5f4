"""String helpers with Postgres semantics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pg_concat(*parts: Column | str) -> Column:
    """Postgres ``concat``: NULL arguments count as empty strings.

    Spark's ``concat`` returns NULL if any part is NULL and ``concat_ws``
    drops the separator next to a NULL, so neither matches on its own.
    Plain strings are taken as literals.
    """
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit(""))
            for p in parts]
    return F.concat(*cols)


def addr5(c: Column | str) -> Column:
    """``substr(address_hash, 1, 5)``, the address key; NULL stays NULL."""
    return F.substring(_col(c), 1, 5)


def brand_key(name: Column | str,
              brands: Sequence[tuple[str, Sequence[str]]],
              otherwise_upper: bool = True) -> Column:
    """First-match brand label for a merchant name.

    ``brands`` is an ordered list of ``(label, like_patterns)``; a name matches
    a label when its upper-cased form is LIKE any of the patterns. Without a
    match the key is the upper-cased name itself (``otherwise_upper``), so the
    same expression can serve as both grouping key and output column.
    """
    upper = F.upper(_col(name))
    expr = None
    for label, patterns in brands:
        cond = None
        for pattern in patterns:
            test = upper.like(pattern)
            cond = test if cond is None else (cond | test)
        expr = (F.when(cond, F.lit(label)) if expr is None
                else expr.when(cond, F.lit(label)))
    if expr is None:
        return upper if otherwise_upper else F.lit(None).cast("string")
    return expr.otherwise(upper) if otherwise_upper else expr
