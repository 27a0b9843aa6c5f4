"""Objects aggregated from rows whose names are not known beforehand.

``object_agg`` is Postgres ``jsonb_object_agg(name, value)`` and ``object_get``
its ``object ->> name``; the object is a typed map. Names are an open set, so
there is no conditional sum per name: rows are first reduced to one value per
(key, name), a partial aggregate that a key with a third of all rows leaves as
one row per name and task, then gathered to one map per key, whose size is the
number of the key's distinct names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_ENTRY = "__tally_entry"


def object_agg(df: DataFrame, keys: Sequence[str], name: str, value: str, alias: str = "object",
               order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key with a map from ``name`` to ``value``.

    Of a repeated name the last value counts, rows being sorted by ``order``;
    without ``order`` a name may occur once per key (a repeated one is an
    error). A NULL name is an error, as in Postgres; a NULL value is kept.
    Names are ordered as Postgres orders those of a jsonb object: shorter
    first, then by their bytes.
    """
    checked = F.coalesce(F.col(name).cast("string"), F.raise_error(F.lit("field name must not be null")).cast("string"))
    rows = df.select(*keys, checked.alias(name), F.col(value).alias(value),
                     *([F.struct(*order).alias("__tally_at")] if order else []))
    if order:
        rows = rows.groupBy(*keys, name).agg(F.max_by(F.struct(value), "__tally_at")[value].alias(value))
    entry = F.struct(F.octet_length(name).alias("n"), F.col(name).alias("name"), F.col(value).alias("value"))
    gathered = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias(_ENTRY))
    return gathered.select(*keys, F.map_from_entries(F.transform(
        _ENTRY, lambda e: F.struct(e["name"], e["value"]))).alias(alias))


def object_get(obj: Column | str, name: Column | str) -> Column:
    """``object ->> name``: the value as text, NULL without such a name. A plain string is a literal."""
    return F.try_element_at(F.col(obj) if isinstance(obj, str) else obj,
                            F.lit(name) if isinstance(name, str) else name).cast("string")


def _quoted(c: Column) -> Column:
    """A JSON string."""
    whole = F.to_json(F.array(c))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def jsonb_text(df: DataFrame, obj: str) -> Column:
    """The text Postgres shows for the jsonb object in column ``obj``, a map of strings, numbers or booleans."""
    text = isinstance(df.schema[obj].dataType.valueType, StringType)
    value = lambda v: F.coalesce(_quoted(v) if text else v.cast("string"), F.lit("null"))
    fields = F.transform(F.map_entries(obj), lambda e: F.concat(_quoted(e["key"]), F.lit(": "), value(e["value"])))
    return F.concat(F.lit("{"), F.array_join(fields, ", "), F.lit("}"))
