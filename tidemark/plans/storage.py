"""Where tables go: scratch folders that all executors share, and tables that are overwritten by partition."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder that all executors share: under ``spark.checkpoint.dir``, or the warehouse where that is unset.

    Where executors run on other machines and neither is set, the warehouse is a folder of the driver alone: that is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        remote = not (spark.conf.get("spark.master", None) or "local").startswith("local")
        if remote and (warehouse.startswith("file:") or "://" not in warehouse):
            raise ValueError(f"executors do not share {warehouse}: set spark.checkpoint.dir to a folder that all of them reach")
        shared = warehouse + "/scratch"
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"


def store(table: DataFrame, directory: str, name: str) -> DataFrame:
    """Write a table once and go on from the stored copy: lineage ends here and its real size is known."""
    path = f"{directory}/{name}"
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def store_all(tables: Mapping[str, DataFrame], directory: str, at_once: int = 4) -> dict[str, DataFrame]:
    """``store`` for several tables that do not read each other: a few are written at a time, so that the tail of one and the planning
    of the next do not leave executors idle."""
    with ThreadPoolExecutor(at_once) as pool:
        stored = pool.map(lambda item: store(item[1], directory, item[0]), tables.items())
        return dict(zip(tables, stored))


def _on_storage(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _on_storage(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that is no longer needed; a missing one is no error."""
    files, place = _on_storage(spark, path)
    files.delete(place, True)


def overwrite_partitions(table: DataFrame, path: str, column: str) -> None:
    """Replace those partitions of the table at ``path`` that ``table`` has rows for; the others stay as they are.

    A day's rows are brought together first, so that a partition gets few files, and a day far larger than others several.
    """
    rows = table.hint("rebalance", column)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
