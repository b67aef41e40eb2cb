"""Join helpers: size-checked broadcast, mark joins, null-safe key joins, as-of join.

SURVEY J3-J7, J12, J13.  A broadcast is only requested for a side whose bytes
were measured (one partial aggregate, nothing gathered); larger sides fall back
to a shuffle join that AQE can still turn into a broadcast at run time from real
statistics.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes, as rows in memory, of a side that is broadcast on request.
BROADCAST_BYTES = 64 << 20
ROW_OVERHEAD = 32  # row header, null bits and hash entry


def row_bytes(df: DataFrame) -> Column:
    """Size of a row in a join's hash table: eight bytes a column, and the bytes of texts and nested values."""
    size = F.lit(ROW_OVERHEAD + 8 * len(df.columns)).cast("long")
    for f in df.schema:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size += F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18:
            size += F.lit(16)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size += F.coalesce(F.octet_length(F.to_json(F.struct(c.alias("v")))), F.lit(0)) * 2
    return size


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if the rows of df take at most ``max_bytes``, else df unchanged.  Wide rows count as wide."""
    n = df.agg(F.sum(row_bytes(df))).first()[0] or 0
    return F.broadcast(df) if n <= max_bytes else df


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join where NULL keys match NULL keys (``<=>``); right key columns are dropped."""
    ren = {k: f"__r_{k}" for k in on}
    r = right.select(*[F.col(c).alias(ren.get(c, c)) for c in right.columns])
    cond = [left[k].eqNullSafe(r[ren[k]]) for k in on]
    return left.join(r, cond, how).drop(*ren.values())


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str,
              right_cols: Sequence[str], prefix: str = "", bucket_days: int = 31) -> DataFrame:
    """Backward as-of join (J12): for each left row, the right row with the latest
    time at or before the left time, per ``by`` key.  A right row at exactly the
    left time is visible.  Output: left columns + ``prefix + c`` for right_cols.

    Skew-aware: time is cut into buckets of ``bucket_days``.
    1. per (key, bucket) the last right row (a partial aggregate);
    2. per key, the last right bucket strictly before each left bucket, by a
       window over *bucket summaries* (a few rows per key, however hot the key);
    3. inside a (key, bucket) partition, a running ``last(ignorenulls)`` over
       the union of left and right rows ordered by time.
    A key holding a third of all rows is spread over its time buckets, and no
    pair of rows is ever emitted.  A NULL key or a NULL time matches nothing.
    """
    ts_l, ts_r = F.col(left_ts), F.col(right_ts)

    def bucket(t):
        return F.floor(F.unix_date(t.cast("date")) / F.lit(bucket_days)).cast("bigint")

    payload = F.struct(*[F.col(c).alias(c) for c in right_cols])
    known = ts_r.isNotNull()
    for k in by:  # an equality never matches NULL keys
        known &= F.col(k).isNotNull()
    r = (right.filter(known)
         .select(*by, ts_r.alias("__t"), bucket(ts_r).alias("__b"), payload.alias("__v")))
    l = left.select(*by, ts_l.alias("__t"), bucket(ts_l).alias("__b"),
                    F.struct(*[F.col(c) for c in left.columns]).alias("__l"))
    # 1. last right row per (key, bucket)
    summ = r.groupBy(*by, "__b").agg(F.max_by("__v", "__t").alias("__v"))
    # 2. carry: last summary of an earlier bucket, for every left (key, bucket)
    lk = l.select(*by, "__b").distinct().withColumn("__side", F.lit(1)).withColumn("__v", F.lit(None).cast(summ.schema["__v"].dataType))
    u = summ.withColumn("__side", F.lit(0)).unionByName(lk)
    w = (Window.partitionBy(*by).orderBy(F.col("__b").asc_nulls_first(), F.col("__side").desc())
         .rowsBetween(Window.unboundedPreceding, 0))
    carry = (u.withColumn("__carry", F.last("__v", ignorenulls=True).over(w))
             .filter(F.col("__side") == 1).select(*by, "__b", "__carry"))
    # 3. within the bucket
    rr = r.withColumn("__side", F.lit(0)).withColumn("__l", F.lit(None).cast(l.schema["__l"].dataType))
    ll = l.withColumn("__side", F.lit(1)).withColumn("__v", F.lit(None).cast(r.schema["__v"].dataType))
    u2 = rr.unionByName(ll)
    w2 = (Window.partitionBy(*by, "__b").orderBy(F.col("__t"), F.col("__side"))
          .rowsBetween(Window.unboundedPreceding, 0))
    inb = (u2.withColumn("__in", F.last("__v", ignorenulls=True).over(w2)).filter(F.col("__side") == 1)
           .select(*by, "__b", "__l", "__in"))
    j = join_null_safe(inb, carry, [*by, "__b"], "left")
    val = F.coalesce(F.col("__in"), F.col("__carry"))
    return j.select(*[F.col("__l")[c].alias(c) for c in left.columns],
                    *[val[c].alias(f"{prefix}{c}") for c in right_cols])


#: Most buckets one interval is expanded to; buckets widen with the span of the points beyond that.
INTERVAL_BUCKETS = 64
DAY = 86400 * 1000000


def range_join(left: DataFrame, right: DataFrame, on: Sequence[str], point: Column | str,
               start: str, end: str, how: str = "left", bucket_days: int = 31, half_open: bool = False) -> DataFrame:
    """Equi keys + ``start <= point <= end`` for dates or timestamps (J13): the effective-dated join.

    With ``half_open`` the end itself is outside (``point < end``).

    Time is cut into buckets.  An interval is expanded to the buckets that it touches between the first and the last
    point of ``left`` (one aggregate), at most INTERVAL_BUCKETS; a point lies in one.  The join is an equi join on keys
    and bucket with the boundaries as a residual, so a pair is found once, a key with many versions meets each row
    with the few of its bucket, and a hot key is spread over its buckets (and split further by the skew join).

    An inner join cuts buckets on levels, each a quarter as wide as the one above.  An interval lies on the level whose
    buckets are just wider than it, and touches two of these at most; a point looks at its bucket of every level that
    holds intervals (one aggregate finds them).  So a point meets the intervals about as long as they are far from it,
    however many a bucket of the first level holds: the work grows with points, intervals and result.  Other joins
    have the first level only (a point without a match has to stay one row).

    A null end is open; a null start, a null point or a null key matches nothing.  Output: the columns of ``left``, then
    those of ``right`` without the keys.
    """
    p = F.col(point) if isinstance(point, str) else point

    def micros(t):
        return F.unix_micros(t.cast("timestamp"))

    first, last = left.agg(F.min(micros(p)), F.max(micros(p))).first()
    rest = [c for c in right.columns if c not in on]
    if first is None:
        first, last = 0, -1
    top = max(bucket_days * DAY, -(-(last - first + 1) // (INTERVAL_BUCKETS - 1)))

    def bucket(t, level):
        return F.expr("{} div greatest(shiftright({}L, 2 * {}), 1L)".format("({} - {}L)".format(t, first), top, level))

    known = F.col(start).isNotNull()
    for k in on:
        known &= F.col(k).isNotNull()
    span = right.filter(known).select(
        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(on)], F.struct(*[F.col(c) for c in rest]).alias("__right"),
        F.col(start).alias("__start"), F.col(end).alias("__end"), F.greatest(micros(F.col(start)), F.lit(first)).alias("__low"),
        F.least(F.coalesce(micros(F.col(end)), F.lit(last)), F.lit(last)).alias("__high")).filter("__low <= __high")
    if how == "inner":
        narrower = F.floor(F.ln(F.lit(float(top)) / (F.col("__high") - F.col("__low") + 1)) / math.log(4)).cast("int")
        span = span.withColumn("__rl", F.greatest(narrower, F.lit(0)))
        levels = sorted(r[0] for r in span.select("__rl").distinct().collect())     # one for each power of four: a few dozen at most
    else:
        span, levels = span.withColumn("__rl", F.lit(0)), [0]
    r = span.select("*", F.explode(F.sequence(bucket("__low", "__rl"), bucket("__high", "__rl"))).alias("__rb")).drop("__low", "__high")
    l = left.select("*", p.alias("__point"), (micros(p)).alias("__at"))
    l = l.withColumn("__ll", F.lit(levels[0] if levels else 0) if len(levels) < 2 else F.explode(F.array(*[F.lit(x) for x in levels])))
    l = l.withColumn("__lb", bucket("__at", "__ll")).drop("__at")
    before_end = F.col("__point") < F.col("__end") if half_open else F.col("__point") <= F.col("__end")
    cond = ((F.col("__ll") == F.col("__rl")) & (F.col("__lb") == F.col("__rb")) & (F.col("__point") >= F.col("__start"))
            & (F.col("__end").isNull() | before_end))
    for i, c in enumerate(on):
        cond &= l[c] == F.col(f"__k{i}")
    return l.join(r, cond, how).select(*left.columns, *[F.col("__right")[c].alias(c) for c in rest])
