"""Exact quantiles and ranks without sorting a whole group in one task.

Values are whole numbers (cents, seconds, millionths). They are counted first;
a value then falls into one of about 30,000 logarithmic buckets (the leading
nine bits), so the window over the buckets of a group is small for any data.
Only the buckets that hold a wanted rank are looked at value by value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def magnitude_bucket(value: Column) -> Column:
    """Order-preserving bucket of a whole number (its sign and leading bits)."""
    size = F.abs(value)
    bits = F.floor(F.log2(size.cast("double"))).cast("int")
    shifted = F.call_function("shiftright", size, bits - 8)
    code = F.when(size < 512, size).otherwise(bits * 512 + shifted)
    return F.when(value < 0, -code).otherwise(code).cast("bigint")


def _cells(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_b", magnitude_bucket(F.col("_v")))
    )


def _buckets(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before each bucket and rows of the whole group."""
    group = Window.partitionBy(*keys)
    upward = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return (
        cells.groupBy(*keys, "_b")
        .agg(F.sum("_n").alias("_bn"))
        .withColumn("_before", F.coalesce(F.sum("_bn").over(upward), F.lit(0)))
        .withColumn("_total", F.sum("_bn").over(group))
    )


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]
) -> DataFrame:
    """Interpolated quantiles (continuous percentile) of ``value`` per group.

    One row per group with one double column per entry of ``quantiles``.
    """
    cells = _cells(df, keys, value)
    position = {q: (F.col("_total") - 1) * F.lit(float(q)) for q in quantiles.values()}

    def ranks(q):
        return F.floor(position[q]), F.ceil(position[q])

    def inside(rank: Column, start: Column, size: Column) -> Column:
        return (rank >= start) & (rank < start + size)

    wanted = [
        inside(r, F.col("_before"), F.col("_bn"))
        for q in quantiles.values()
        for r in ranks(q)
    ]
    needed = (
        _buckets(cells, keys).filter(reduce(lambda a, b: a | b, wanted)).drop("_bn")
    )
    upward = (
        Window.partitionBy(*keys, "_b")
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    fine = cells.join(needed, [*keys, "_b"]).withColumn(
        "_start", F.col("_before") + F.coalesce(F.sum("_n").over(upward), F.lit(0))
    )
    picks = [F.max("_total").alias("_total")]
    for name, q in quantiles.items():
        for side, rank in zip(("lo", "hi"), ranks(q)):
            hit = inside(rank, F.col("_start"), F.col("_n"))
            picks.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{name}_{side}"))
    found = fine.groupBy(*keys).agg(*picks)
    result = []
    for name, q in quantiles.items():
        lo = F.col(f"_{name}_lo").cast("double")
        hi = F.col(f"_{name}_hi").cast("double")
        part = position[q] - F.floor(position[q])
        result.append((lo + (hi - lo) * part).alias(name))
    return found.select(*keys, *result)


def with_rank_share(df: DataFrame, value: str, name: str) -> DataFrame:
    """Share of the other rows with a smaller value (percent rank), over all rows."""
    cells = _cells(df, [], value)
    buckets = _buckets(cells, []).select("_b", "_before", "_total")
    upward = (
        Window.partitionBy("_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    )
    smaller = F.col("_before") + F.coalesce(F.sum("_n").over(upward), F.lit(0))
    ranked = cells.join(buckets, "_b").select(
        F.col("_v").alias(value),
        F.when(F.col("_total") > 1, smaller / (F.col("_total") - 1))
        .otherwise(F.lit(0.0))
        .alias(name),
    )
    return df.join(ranked, value, "left")
