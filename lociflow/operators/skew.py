"""Joins and ordered lookups that stay balanced when one key holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How many ways the rows of one key are spread; the small side is repeated as often.
SALTS = 16


def salted_join(big: DataFrame, small: DataFrame, on: str | list[str], spread: Column, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join where ``small`` has at most a few rows a key and ``big`` may have very many.

    Every key of ``big`` is split over ``salts`` reducers by ``spread`` (a column that varies
    within the key), and each row of ``small`` is sent to all of them. No side is broadcast,
    so nothing has to fit in one process. ``how`` is inner, left, left_semi or left_anti.
    Null keys match nothing, as in SQL.
    """
    keys = [on] if isinstance(on, str) else list(on)
    slot = "__salt"
    left = big.withColumn(slot, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = small.withColumn(slot, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, slot], how).drop(slot)


def bucketed_lag(df: DataFrame, key: str, order: list[str], time: str, columns: list[str], prefix: str = "prev_") -> DataFrame:
    """``lag(columns)`` over (``key`` ordered by ``order``), without sorting a hot key in one task.

    ``order`` starts with ``time``. Rows are windowed within (key, day of ``time``); only the last
    row of each day goes into a second window over the days of a key, so a task holds one day of
    a key or one row a day. Rows with a null ``time`` come first, as one day of their own.
    Adds ``prefix + column`` and ``prefix + 'exists'``.
    """
    day = "__day"
    rows = df.withColumn(day, F.coalesce(F.datediff(F.col(time), F.lit("1970-01-01")), F.lit(-(2**31) + 1)))
    ordering = [F.col(c).asc_nulls_first() for c in order]
    packed = F.struct(*[F.col(c) for c in columns])
    inner = Window.partitionBy(key, day).orderBy(*ordering)
    within = rows.withColumn("__lag", F.lag(packed).over(inner))
    sort_key = F.struct(*[c for name in order for c in (F.col(name).isNotNull(), F.col(name))])
    last = rows.groupBy(key, day).agg(F.max_by(packed, sort_key).alias("__tail"))
    across = last.select(key, day, F.lag("__tail").over(Window.partitionBy(key).orderBy(day)).alias("__before"))
    joined = within.join(across, [key, day], "left")
    both = F.coalesce("__lag", "__before")
    named = joined.withColumn("__both", both)
    for c in columns:
        named = named.withColumn(prefix + c, F.col("__both")[c])
    return named.withColumn(prefix + "exists", F.col("__both").isNotNull()).drop("__lag", "__before", "__both", day)
