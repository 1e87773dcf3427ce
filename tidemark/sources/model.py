"""Exported model tables: write and read back by name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def export_parquet(
    tables: Mapping[str, DataFrame],
    directory: str,
    partition_by: Mapping[str, list[str]] | None = None,
) -> None:
    """Write every table as Parquet under ``directory/<name>``, replacing what is there.

    ``partition_by`` lists partition columns per table. Such a table is rebalanced on them first, so that a
    partition gets few files and adaptive execution still splits a day far larger than the others.
    """
    for name, table in tables.items():
        columns = list((partition_by or {}).get(name, []))
        if columns:
            table = table.hint("rebalance", *columns)
        table.write.mode("overwrite").partitionBy(*columns).parquet(f"{directory}/{name}")


def read_model(spark: SparkSession, directory: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The named tables of an exported model."""
    return {name: spark.read.parquet(f"{directory}/{name}") for name in names}
