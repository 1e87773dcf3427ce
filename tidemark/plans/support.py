"""All ticket KPIs for one date range."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import support
from tidemark.operators.support import Moment
from tidemark.plans.storage import scratch_dir, store


def run_ticket_kpis(
    tickets: DataFrame,
    start: Moment | None = None,
    end: Moment | None = None,
    *,
    as_of: Moment,
    work_dir: str | None = None,
) -> dict[str, DataFrame]:
    """The ticket KPI tables by name, all from one pass over ``tickets``.

    The pass groups tickets by every dimension at once and stores the groups, under ``work_dir`` or the shared scratch folder; the
    tables read nothing else.
    """
    rollup = support.kpi_rollup(tickets, start, end, as_of=as_of)
    return support.tables_of_rollup(store(rollup, work_dir or scratch_dir(tickets.sparkSession), "ticket_rollup"))
