"""Exact grouped quantiles that never hold one group's values in a single task.

``percentile`` and ``median`` keep every distinct value of a group in one aggregation buffer, so a group that owns
a third of all rows breaks them. Here ranks are located by narrowing. A histogram over magnitude buckets, combined
map-side, shows which buckets hold the wanted ranks; only rows in those buckets go on to finer buckets and at last to
single values. Every window runs over the buckets of one key or over the at most 2^20 values of one fine bucket.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import null_safe_join

_COARSE_BITS = 12
_FINE_BITS = 32
_BUCKET_SPAN = 1 << 40


def _bucket(value: Column, bits: int) -> Column:
    """Order-preserving bucket number: binary exponent, then ``bits`` bits of the mantissa."""
    size = F.abs(value)
    exponent = F.greatest(F.floor(F.log2(size)), F.lit(-900))
    mantissa = F.floor(size * F.pow(F.lit(2.0), F.lit(bits) - exponent)).cast("bigint")
    positive = (exponent + 1000).cast("bigint") * _BUCKET_SPAN + mantissa
    top = F.lit(1 << 62)
    return (
        F.when(value == 0, F.lit(0).cast("bigint"))
        .when(F.isnan(value) | (value == float("inf")), top)
        .when(value == float("-inf"), -top)
        .when(value > 0, positive)
        .otherwise(-positive)
    )


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    quantiles: dict[str, float],
    weight: str | None = None,
) -> DataFrame:
    """One row per key with linearly interpolated quantiles of ``value``.

    ``quantiles`` maps output column names to probabilities. ``weight`` names a column that says how many times a
    row counts. NULL values are ignored; a key without values has no row, and without keys there is always one row.
    """
    val = F.col(value)
    times = F.col(weight) if weight else F.lit(1)
    # NULL values weigh nothing instead of being filtered out: a filter would be pushed into the scan and keep Spark
    # from sharing a shuffle inside ``df`` with other consumers.
    rows = df.select(
        *keys,
        val.cast("double").alias("__v"),
        F.when(val.isNotNull(), times).otherwise(0).cast("bigint").alias("__n"),
    ).withColumn("__coarse", _bucket(F.col("__v"), _COARSE_BITS))

    positions = {name: F.lit(p) * (F.col("__total") - 1) for name, p in quantiles.items()}
    ranks = [f(pos).cast("bigint") for pos in positions.values() for f in (F.floor, F.ceil)]

    def holds(rank: Column) -> Column:
        return (rank >= F.col("__start")) & (rank < F.col("__start") + F.col("__n"))

    wanted = reduce(or_, [holds(rank) for rank in ranks])

    def place(rows: DataFrame, path: list[str], level: str) -> DataFrame:
        before = (
            Window.partitionBy(*path).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        )
        return rows.withColumn("__start", F.col("__base") + F.coalesce(F.sum("__n").over(before), F.lit(0)))

    def lookup(hits: DataFrame, path: list[str]) -> DataFrame:
        found = hits.select(*path, F.col("__start").alias("__base"), "__total")
        # Without keys at most two buckets per quantile are left, which is a proven bound.
        return found if keys else F.broadcast(found)

    coarse = (
        rows.groupBy(*keys, "__coarse")
        .agg(F.sum("__n").alias("__n"))
        .withColumn("__total", F.sum("__n").over(Window.partitionBy(*keys)))
        .withColumn("__base", F.lit(0).cast("bigint"))
    )
    path = [*keys, "__coarse"]
    hits = lookup(place(coarse, keys, "__coarse").where(wanted), path)
    near = (
        null_safe_join(rows, hits, path)
        .groupBy(*path, "__v")
        .agg(F.sum("__n").alias("__n"), F.max("__base").alias("__base"), F.max("__total").alias("__total"))
        .withColumn("__fine", _bucket(F.col("__v"), _FINE_BITS))
    )
    fine = near.groupBy(*path, "__fine").agg(
        F.sum("__n").alias("__n"), F.max("__base").alias("__base"), F.max("__total").alias("__total")
    )
    hits = place(fine, path, "__fine").where(wanted)
    path = [*path, "__fine"]
    # Both readers of ``near`` use all its columns, so that it is shuffled once: the finer start is the greater one.
    hits = lookup(hits, path).drop("__total").withColumnRenamed("__base", "__fine_base")
    joined = null_safe_join(near, hits, path).withColumn("__base", F.greatest("__base", "__fine_base")).drop("__fine_base")
    hits = place(joined, path, "__v").where(wanted)

    picks = []
    for name, pos in positions.items():
        picks.append(F.max(F.when(holds(F.floor(pos).cast("bigint")), F.col("__v"))).alias(f"__lo_{name}"))
        picks.append(F.max(F.when(holds(F.ceil(pos).cast("bigint")), F.col("__v"))).alias(f"__hi_{name}"))
    found = hits.groupBy(*keys).agg(F.max("__total").alias("__total"), *picks)
    out = []
    for name, pos in positions.items():
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        step = pos - F.floor(pos)
        out.append(F.when(step == 0, lo).otherwise(lo + (hi - lo) * step).alias(name))
    return found.select(*keys, *out)


def quantile_sketches(df: DataFrame, keys: list[str], value: str, k: int = 1000) -> DataFrame:
    """One row per key with a KLL sketch of ``value``; NULL values are ignored, and a key without values has no row.

    Sketches have a bounded size, whatever the number of values, and those of several rows (days, say) can be united. The rank of a quantile
    taken from one is wrong by about 2.3 / k^0.9 of the values at most (99 % of the time).
    """
    rows = df.where(F.col(value).isNotNull())
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch")
    return rows.groupBy(*keys).agg(sketch).where("sketch is not null")


def quantiles_of_sketches(sketches: DataFrame, keys: list[str], quantiles: dict[str, float], k: int = 1000) -> DataFrame:
    """One row per key with approximate quantiles and ``n``, the number of values, from the united sketches of its rows."""
    united = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in quantiles.items()]
    return united.select(*keys, *found, F.kll_sketch_get_n_double("sketch").alias("n"))
