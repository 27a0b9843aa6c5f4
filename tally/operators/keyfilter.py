"""Key filters built at run time, applied to a large table before its shuffle.

A report that wants few of a large table's keys, but must aggregate or pick
the newest row per key first, shuffles every row of every key. A key filter is
a Bloom filter of one hash made of two built-in bitmap aggregates: the wanted
keys set bits of ``bits`` in rows of 32,768 bits, and a row of the large table
passes if its key's bit is set. Wrong passes are left to the exact join that
follows; no wanted row is lost.

The filter has at most ``bits`` / 32,768 rows of 4 KB however many keys there
are, so it is broadcast: 16 MB at the default. Keys beyond about its size make
it pass more, never less.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 27
_PART, _MAP, _HIT = "__tally_part", "__tally_bits", "__tally_hit"


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_filter(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """Bitmap rows of the non-NULL keys."""
    place = _place(F.col(key), bits)
    return (keys.where(F.col(key).isNotNull())
                .groupBy(F.bitmap_bucket_number(place).alias(_PART))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(_MAP)))


def may_match(df: DataFrame, key: str, wanted: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows of ``df`` whose key may be among those of ``wanted`` (``key_filter`` of as many bits); NULL keys go.

    The keys of both sides must have one type, as their hashes are compared.
    """
    return _marked(df, key, wanted, bits, "inner").where(_HIT).select(df.columns)


def cannot_match(df: DataFrame, key: str, wanted: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows that ``may_match`` leaves out, those of NULL keys included."""
    return _marked(df, key, wanted, bits, "left").where(~F.coalesce(F.col(_HIT), F.lit(False))).select(df.columns)


def _marked(df: DataFrame, key: str, wanted: DataFrame, bits: int, how: str) -> DataFrame:
    place = _place(F.col(key), bits)
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(_MAP, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (bit % 8).cast("int")) == 1
    small = F.broadcast(wanted)         # at most bits / 32,768 rows
    on = (F.bitmap_bucket_number(place) == F.col(_PART)) & F.col(key).isNotNull()
    return df.join(small, on, how).select(*df.columns, hit.alias(_HIT))
