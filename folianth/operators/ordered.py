"""Ordered scans that don't put a whole key into one task.

A window over a key sorts all its rows in one task, however many there are. Here a key is cut into buckets of its order;
each bucket is scanned on its own, and one row for each bucket passes on what the later buckets need to know. With BUCKET rows in a
bucket a key of 10^11 rows has some 400,000 buckets, which one task scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 1 << 18


def scan(df: DataFrame, keys: list[str], order: list[str], bucket: Column, previous: dict[str, Column] | None = None, following: dict[str, Column] | None = None, max_before: dict[str, Column] | None = None, sum_before: dict[str, Column] | None = None) -> DataFrame:
    """Add columns over the rows of a key in order.

    `previous`/`following`: the value in the row before/after (null at the ends); `max_before`: the largest value of all rows
    before; `sum_before`: the sum of all rows before (0 at the start). `bucket` must not fall with the order: it cuts the key.
    Null keys are a key of their own. Ties in `order` must be broken by the caller's columns.
    """
    previous, following, max_before, sum_before = previous or {}, following or {}, max_before or {}, sum_before or {}
    place = [*keys, "_b"]
    rows = df.withColumn("_b", F.coalesce(bucket, F.lit(0)).cast("bigint"))
    inner = Window.partitionBy(*place).orderBy(*order)
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    at = F.struct(*order)
    parts = [F.count(F.lit(1)).alias("_n")]
    parts += [F.max_by(F.struct(v.alias("v")), at).alias(f"_p{i}") for i, v in enumerate(previous.values())]
    parts += [F.min_by(F.struct(v.alias("v")), at).alias(f"_f{i}") for i, v in enumerate(following.values())]
    parts += [F.max(v).alias(f"_m{i}") for i, v in enumerate(max_before.values())]
    parts += [F.sum(v).alias(f"_s{i}") for i, v in enumerate(sum_before.values())]
    ends = rows.groupBy(*place).agg(*parts)
    outer = Window.partitionBy(*keys).orderBy("_b")
    earlier = outer.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *(F.col(k).alias(f"_k{i}") for i, k in enumerate(place)),
        *(F.lag(f"_p{i}").over(outer).alias(f"_cp{i}") for i in range(len(previous))), *(F.lead(f"_f{i}").over(outer).alias(f"_cf{i}") for i in range(len(following))),
        *(F.max(f"_m{i}").over(earlier).alias(f"_cm{i}") for i in range(len(max_before))), *(F.sum(f"_s{i}").over(earlier).alias(f"_cs{i}") for i in range(len(sum_before))),
        F.lit(True).alias("_c"),
    )
    rows = rows.withColumns(
        {f"_lp{i}": F.lag(F.struct(v.alias("v"))).over(inner) for i, v in enumerate(previous.values())} | {f"_lf{i}": F.lead(F.struct(v.alias("v"))).over(inner) for i, v in enumerate(following.values())}
        | {f"_lm{i}": F.max(v).over(before) for i, v in enumerate(max_before.values())} | {f"_ls{i}": F.sum(v).over(before) for i, v in enumerate(sum_before.values())}
    )
    on = None
    for i, k in enumerate(place):
        one = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        on = one if on is None else on & one
    out = rows.join(carried, on, "left")
    names = [
        *((n, F.coalesce(F.col(f"_lp{i}"), F.col(f"_cp{i}"))["v"]) for i, n in enumerate(previous)), *((n, F.coalesce(F.col(f"_lf{i}"), F.col(f"_cf{i}"))["v"]) for i, n in enumerate(following)),
        *((n, F.greatest(F.col(f"_lm{i}"), F.col(f"_cm{i}"))) for i, n in enumerate(max_before)), *((n, F.coalesce(F.col(f"_ls{i}"), F.lit(0)) + F.coalesce(F.col(f"_cs{i}"), F.lit(0))) for i, n in enumerate(sum_before)),
    ]
    return out.select(*(f"`{c}`" for c in df.columns), *(c.alias(n) for n, c in names))


def numbered(df: DataFrame, keys: list[str], order: list[str], bucket: Column, name: str = "item_no") -> DataFrame:
    """Number the rows of a key from 1 in order."""
    out = scan(df, keys, order, bucket, sum_before={name: F.lit(1).cast("bigint")})
    return out.withColumn(name, F.col(name) + 1)
