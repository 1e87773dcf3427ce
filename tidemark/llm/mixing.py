"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_order, n_words, packed
from tidemark.plans.storage import store

WEIGHTS = (5, 2, 1)
CAP = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size and target for every source of ``sizes`` (source, size).

    Sources in code point order, null last, get the weights in turn. All sizes are shared out by weight; a target stops at ``cap``
    times its source's size and the excess goes to the others by weight. That is one water level: with the sources in the order of
    cap per weight, the first whose cap lies above the level left by its predecessors sets it for all that follow. One row per
    source enters the windows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
    table = table.withColumn("most", F.col("source_size").cast("double") * cap)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    table = table.withColumns({"level": left / open_weight, "place": F.row_number().over(by_ratio)})
    fits = F.col("level") < F.col("most") / F.col("weight")
    level = F.min(F.when(fits, F.struct("place", "level"))).over(everything)["level"]
    target = F.when(F.col("most") <= F.coalesce(level, F.lit(float("inf"))) * F.col("weight"), F.col("most"))
    return table.withColumn("target", F.coalesce(target, level * F.col("weight"))).select("source", "source_size", "target")


def offset(source: F.Column, seed: str) -> F.Column:
    """A random number in [0, 1) for each source, the same in every run with the seed."""
    name = F.concat(F.lit(f"{seed}|"), F.coalesce(F.concat(F.lit("="), source), F.lit("null")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix(docs: DataFrame, folder: str, keep: list[str], weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = "mix") -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source) with how often the mix takes it: the columns ``keep`` of the row as the struct
    ``_row``, source, size, source_size, target and copies.

    A size is a number of words. A document is expected target / source_size times, at most ``cap``; the expectations are added up
    within the source, one random offset is added, and a document is taken once for each whole number that its part of the sum crosses.
    Documents go from the largest to the smallest, so that what is taken stays within about one largest document of the
    target; ties go by doc_id and then by text, so reruns agree. Repeated rows are sampled one by one. A null or empty text has size 0; a
    source of size 0 has target 0 and nothing is taken. A null source is one like any other, a null doc_id comes before the others. Only
    the size of a very long text counts, which is read whole. Extra columns, whatever their names, stay in ``_row``. An empty table gives an
    empty result.

    No source is gathered: rows are sorted in ranges, a row's place in its source follows from its place in the range and the counts of
    the source's earlier ranges.
    """
    rows = packed(docs, "doc_id", "text", F.col("source").cast("string").alias("source"))
    row = F.struct(*[F.col(f"_row.`{c}`").alias(c) for c in keep]).alias("_row")
    rows = rows.select(row, "source", F.col("doc_id").alias("_id"), n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_tie"))
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("_id").asc(), F.col("_tie").asc()]
    placed = in_order(rows, order, folder, "placed")
    runs = placed.groupBy("source", "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"), F.sum("size").alias("size"))
    runs = store(runs, folder, "runs")
    targets = store(source_targets(runs, weights, cap), folder, "targets")
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("base")
    starts = runs.select(F.col("source").alias("_source"), F.col("_part").alias("_of"), base)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate")
    plan = starts.join(targets, F.col("_source").eqNullSafe(F.col("source")))
    plan = store(plan.select("_source", "_of", "base", "source_size", "target", rate, offset(F.col("source"), seed).alias("u")), folder, "plan")
    found = placed.join(plan, (placed["_part"] == plan["_of"]) & placed["source"].eqNullSafe(plan["_source"]))
    before = (F.col("_at") + F.col("base")).cast("double")
    crossed = F.floor((before + 1) * F.col("rate") + F.col("u")) - F.floor(before * F.col("rate") + F.col("u"))
    return found.select("_row", "source", "size", "source_size", "target", crossed.alias("copies"))


def mixed(docs: DataFrame, folder: str, **options) -> DataFrame:
    """The rows that the mix takes, repeated as often as it takes them, with all columns of ``docs``."""
    names = docs.columns
    found = mix(docs, folder, names, **options).where("copies > 0")
    repeated = found.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])
