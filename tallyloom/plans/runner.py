"""Platform runs over many tables.

The driver only walks the table list; each table is one Spark plan. Tenants are
a column of the data, so all of them go through the same job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime
from graphlib import TopologicalSorter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.columns import drop_columns
from tallyloom.plans.compiled import keyed
from tallyloom.plans.steps import Context
from tallyloom.plans.tables import TableDef
from tallyloom.schemas import SUMMARY
from tallyloom.sinks.snapshot import SnapshotTable, load_table, write_alerts
from tallyloom.sinks.spec import target_name
from tallyloom.sinks.stats import LoadStats


@dataclass
class RunResult:
    """Counters of the tables that loaded, messages of those that did not."""

    platform: str
    execution_id: str
    start: datetime
    loaded: dict[str, LoadStats] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)

    @property
    def status(self) -> str:
        if not self.failed:
            return "success"
        return "partial_success" if self.loaded else "failed"

    @property
    def exit_code(self) -> int:
        return 0 if not self.failed else 3

    @property
    def totals(self) -> LoadStats:
        return sum(self.loaded.values(), LoadStats())

    def summary(self, spark: SparkSession, end: datetime, metadata: Mapping[str, str] | None = None) -> DataFrame:
        """K14 input: one summary row; failed tables count as zero rows."""
        zero = dict.fromkeys(LoadStats().to_dict(), 0)
        tables = [{"name": n, "success": True, **s.to_dict(), "error": None} for n, s in self.loaded.items()]
        tables += [{"name": n, "success": False, **zero, "error": m} for n, m in self.failed.items()]
        totals = {f"total_{k}": v for k, v in self.totals.to_dict().items()}
        row = {
            "execution_id": self.execution_id,
            "platform": self.platform,
            "status": self.status,
            "start_time": self.start.isoformat(),
            "end_time": end.isoformat(),
            "duration_seconds": (end - self.start).total_seconds(),
            "tables": tables,
            "tables_count": len(tables),
            "tables_succeeded": len(self.loaded),
            "tables_failed": len(self.failed),
            **totals,
            "exit_code": self.exit_code,
            "errors": [{"table": n, "message": m} for n, m in self.failed.items()],
            "metadata": dict(metadata or {}),
        }
        return spark.createDataFrame([row], SUMMARY)


def run_order(tables: Mapping[str, TableDef], only: Sequence[str] | None = None) -> list[str]:
    """Tables after those they depend on, otherwise in declared order."""
    wanted = [t for t in tables if only is None or t in only]
    graph = {t: [d for d in tables[t].after if d in wanted] for t in wanted}
    return list(TopologicalSorter(graph).static_order())


def run_platform(
    platform: str,
    tables: Mapping[str, TableDef],
    read: Callable[[TableDef], DataFrame],
    target: Callable[[str, DataFrame, TableDef], SnapshotTable],
    ctx: Context,
    execution_id: str,
    only: Sequence[str] | None = None,
    tenant: tuple[str, Sequence] | None = None,
    alerts: str | None = None,
    test: bool = False,
    dry_run: bool = False,
) -> RunResult:
    """Every table in order, each isolated; a failing one is recorded and the rest go on.

    ``tenant`` (column, values) turns replaces into scoped ones (X4). A dry run
    plans every table and loads none.
    """
    result = RunResult(platform, execution_id, ctx.run_ts)
    for name in run_order(tables, only):
        table = tables[name]
        try:
            rows = table.transform(read(table), ctx)
            if table.guess_keys and not dry_run:
                table = keyed(table, rows)
            spec = replace(table.load, table=target_name(name, test))
            if tenant and spec.mode == "replace":
                spec = replace(spec, scope={tenant[0]: list(tenant[1])})
            if dry_run:
                rows.schema
                result.loaded[name] = LoadStats()
            elif spec.alert_only:
                if alerts:
                    write_alerts(rows, alerts, name)
                result.loaded[name] = LoadStats()
            else:
                sink = target(spec.table, rows, table)
                arrived = with_arrival(rows)
                if spec.keys and not spec.order and ARRIVAL in arrived.columns:
                    rows, spec = arrived, replace(spec, order=(ARRIVAL,))
                result.loaded[name] = load_table(sink, rows, spec, execution_id, ctx.run_ts.date())
        except Exception as e:  # one table must not stop the others
            result.failed[name] = f"{type(e).__name__}: {e}".splitlines()[0]
    return result


ARRIVAL = "__arrival"


def with_arrival(rows: DataFrame) -> DataFrame:
    """``rows`` with their order of arrival: time and name of the landing file, its block, and the place in what a task reads of it.

    Spark keeps the file columns of a scan in reach through selects, filters and explodes, so
    the steps need not carry them. Behind a roll-up or a join there is no arrival any more; such rows come back as they are.
    """
    source = F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("place"))
    try:
        return rows.withColumn(ARRIVAL, source)
    except AnalysisException:
        return rows


def snapshot_targets(spark: SparkSession, root: str) -> Callable[[str, DataFrame, TableDef], SnapshotTable]:
    """Targets under a folder; the first load fixes a table's schema."""

    def open_table(name: str, rows: DataFrame, table: TableDef) -> SnapshotTable:
        return SnapshotTable(spark, f"{root.rstrip('/')}/{name}", drop_columns(rows, ()).schema, table.load.partition_by)

    return open_table


def run_tenants(tenants: Sequence[str], run: Callable[[str], RunResult]) -> dict[str, RunResult]:
    """The result of each tenant where tenants must stay separate runs."""
    return {tenant: run(tenant) for tenant in tenants}


def tenant_totals(runs: Mapping[str, RunResult], platform: str, execution_id: str) -> RunResult:
    """One result over all tenants, loaded and failed tables as ``tenant.table``; its status tells partial success."""
    total = RunResult(platform, execution_id, min(r.start for r in runs.values()))
    for tenant, result in runs.items():
        total.loaded |= {f"{tenant}.{name}": s for name, s in result.loaded.items()}
        total.failed |= {f"{tenant}.{name}": message for name, message in result.failed.items()}
    return total
