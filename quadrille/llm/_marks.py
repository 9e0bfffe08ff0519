"""A bit filter of fixed size that keeps rows out of shuffles, in DataFrame functions only.

Keys are hashed to bits of a table of at most ``WORDS`` rows; every row then
learns by a broadcast join of that bound whether its key may be among them.  A
row that isn't marked surely is not; of the marked ones some aren't either, the
more the more keys there are.  The filter saves work and decides nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the filter, each of four times 64 bits.
WORDS = 1 << 18
_PARTS = range(4)


def _places(key: Column) -> tuple[Column, Column]:
    h = F.xxhash64(key, F.lit(99))
    return h.bitwiseAND(F.lit(WORDS - 1)), F.shiftrightunsigned(h, 18)


def marks(keys: DataFrame, key: Column) -> DataFrame:
    """The filter of ``key`` over the rows of ``keys``; at most WORDS rows."""
    word, bit = _places(key)
    held = [
        F.bit_or(F.when(F.expr(f"__bit >> 6 & 3 = {k}"), F.expr("shiftleft(1L, cast(__bit & 63 as int))")).otherwise(F.lit(0).cast("long"))).alias(f"__m{k}")
        for k in _PARTS
    ]
    return keys.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(*held)


def with_mark(rows: DataFrame, key: Column, found: DataFrame, name: str) -> DataFrame:
    """``rows`` and a column ``name``: false where the key is surely not in the filter."""
    word, bit = _places(key)
    part = F.element_at(F.array(*[F.col(f"__m{k}") for k in _PARTS]), (F.expr("__bit >> 6 & 3") + 1).cast("int"))
    hit = F.expr("__part >> cast(__bit & 63 as int) & 1 = 1")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    joined = rows.select(*columns, word.alias("__at"), bit.alias("__bit")).join(F.broadcast(found), F.col("__at") == F.col("__word"), "left")
    return joined.select(*columns, "__bit", F.coalesce(part, F.lit(0).cast("long")).alias("__part")).select(*columns, hit.alias(name))
