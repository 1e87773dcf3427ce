"""Words, whole rows and shared files: what several operators need."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.storage import store

# Fixed value: a word is a longest run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """Array of words; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """The whole row as the struct ``_row`` beside copies of the named columns, so that no extra column can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return docs.select(row, *names)


def unpacked(table: DataFrame, names: list[str]) -> DataFrame:
    return table.select(*[F.col(f"_row.`{c}`").alias(c) for c in names])


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that what is made from one batch stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; empty for null."""
    return [v if v is not None else b"" for v in column.cast(pa.binary()).to_pylist()]


def write_shared(path: str, body: list[bytes]) -> None:
    """Write a file into a folder that all executors share, complete or not at all.

    A repeated or rival attempt of the same task writes its own temporary file, and the last rename wins.
    """
    store, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    store.create_dir(os.path.dirname(place), recursive=True)
    temporary = f"{os.path.dirname(place)}/.{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as out:
        for part in body:
            out.write(part)
    store.move(temporary, place)


def open_shared(path: str) -> pa.NativeFile:
    """Open a shared file for reading at any place."""
    store, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store.open_input_file(place)


def in_order(table: DataFrame, order: list[Column], folder: str, name: str) -> DataFrame:
    """The stored rows in a total order: ``_part`` and ``_at`` ascend with it, and ``_at`` counts up by one inside a ``_part``."""
    ordered = table.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.withColumn("_at", F.monotonically_increasing_id())
    return store(ordered.withColumn("_part", F.shiftright("_at", 33)), folder, name)


def running_total(table: DataFrame, order: list[Column], value: str, folder: str) -> DataFrame:
    """``table`` with ``_before``: the sum of ``value`` over all earlier rows of the order.

    Each partition adds up its own rows; the one window over everything sees one row for each partition.
    """
    placed = in_order(table, order, folder, "placed")
    sums = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    earlier = F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sums = store(sums.select(F.col("_part"), F.coalesce(earlier, F.lit(0)).alias("_base")), folder, "sums")
    local = F.sum(value).over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("_local", F.coalesce(local, F.lit(0))).join(sums, "_part")
    return placed.withColumn("_before", F.col("_base") + F.col("_local")).drop("_part", "_at", "_local", "_base")


def beta_strength(counts: DataFrame) -> float:
    """How many pseudo-outcomes a parent's rate is worth to its children: method of moments of the beta-binomial.

    The intra-class correlation of the groups (k bad of n) is held between 0.001 and 0.5; without groups to compare it is 0.5.
    """
    total = counts.where("n > 0").agg(F.sum("k"), F.sum("n"), F.sum(F.col("n") * F.col("n")), F.count(F.lit(1)), F.sum(F.col("k") * F.col("k") / F.col("n"))).first()
    k, n, squares, groups, spread = (float(v or 0) for v in total)
    rate = k / n if n else 0.0
    if groups < 2 or rate in (0.0, 1.0):
        correlation = 0.5
    else:
        between = spread - n * rate * rate
        room = n - squares / n - (groups - 1)
        correlation = (between / (rate * (1 - rate)) - (groups - 1)) / room if room > 0 else 0.5
    correlation = min(0.5, max(0.001, correlation))
    return 1 / correlation - 1
