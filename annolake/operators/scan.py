"""Ordered scans (running sum / running max) that stay parallel under skew.

A plain ``Window.partitionBy(key).orderBy(...)`` puts a whole key into one task.
When one recording or stratum holds a third of all rows that task is the job.
The scans here cut each key into ordered chunks (a monotone function of the
order columns, e.g. ``floor(start / 1h)``):

1. aggregate every chunk to one value (map-side combined, tiny output);
2. carry = the scan of the chunk values over the *previous* chunks of the key
   (a window over one row per chunk, so its size is #chunks, not #rows);
3. join the carry back on (key, chunk) and finish the scan inside the chunk.

The join and the inner window share the (key, chunk) hash partitioning, so the
rows go through one exchange. Sum and max are associative, which is all the
carry needs. Results equal the plain window exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CARRY = "_scan_carry"
_VAL = "_scan_val"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


KEY = "_scan_key"
CHUNK = "_scan_ck"


def running_agg(df: DataFrame, by: Sequence[str], order: Sequence, value, out: str,
                fn: str = "sum", chunk_of: Column | None = None, inclusive: bool = True,
                keep_partition_cols: bool = False, total_out: str | None = None) -> DataFrame:
    """``out`` = running ``fn`` (sum|max) of ``value`` within ``by`` in ``order``.

    ``order`` must be a total order inside a key when the result must not depend
    on ties (sum); ``chunk_of`` must be non-decreasing along ``order``.
    ``inclusive=False`` scans the rows strictly before the current one.
    Keys and chunk are wrapped in structs so null keys form a group (as in a
    group-by) and the join stays a plain equi-join; the rows then stay
    hash-partitioned on (KEY, CHUNK), and ``keep_partition_cols`` keeps those
    two columns for a following operator on the same partitioning.
    ``total_out`` adds the aggregate over the whole key, taken from the chunk
    rows and shipped with the carry (no join on the bare key).
    Without ``chunk_of`` this is the plain window (fine when keys are bounded).
    """
    by = list(by)
    order_cols = [_col(o) for o in order]
    agg = {"sum": F.sum, "max": F.max}[fn]
    upper = 0 if inclusive else -1
    d = df.withColumn(_VAL, _col(value))
    if chunk_of is None:
        w = Window.partitionBy(*by).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, upper)
        res = agg(_VAL).over(w)
        if fn == "sum":
            res = F.coalesce(res, F.lit(0).cast(d.schema[_VAL].dataType))
        d = d.withColumn(out, res)
        if total_out:
            d = d.withColumn(total_out, agg(_VAL).over(Window.partitionBy(*by)))
        return d.drop(_VAL)

    d = d.withColumn(KEY, F.struct(*[F.col(b) for b in by])).withColumn(CHUNK, F.struct(chunk_of.alias("c")))
    keys = [KEY, CHUNK]
    per_chunk = d.groupBy(*keys).agg(agg(_VAL).alias("_cv"))
    wc = Window.partitionBy(KEY).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    extra = [agg("_cv").over(Window.partitionBy(KEY)).alias(total_out)] if total_out else []
    carry = per_chunk.select(*keys, agg("_cv").over(wc).alias(_CARRY), *extra)
    d = d.join(carry, keys, "inner")
    wl = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, upper)
    local = agg(_VAL).over(wl)
    if fn == "sum":
        zero = F.lit(0).cast(d.schema[_VAL].dataType)
        res = F.coalesce(F.col(_CARRY), zero) + F.coalesce(local, zero)
    else:
        res = F.greatest(F.col(_CARRY), local)
    d = d.withColumn(out, res).drop(_VAL, _CARRY)
    return d if keep_partition_cols else d.drop(KEY, CHUNK)


def prefix_sum(df: DataFrame, by: Sequence[str], order: Sequence, value, out: str,
               chunk_of: Column | None = None) -> DataFrame:
    """Inclusive running sum."""
    return running_agg(df, by, order, value, out, "sum", chunk_of, inclusive=True)
