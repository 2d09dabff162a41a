"""The one registry of archived tables; every other list is a view of it."""

from __future__ import annotations

from dataclasses import dataclass, field

STREAM, WATERMARK, OVERWRITE = "stream", "watermark", "overwrite"


@dataclass(frozen=True)
class TableSpec:
    schema: str
    table: str
    strategy: str = STREAM
    natural_keys: tuple[str, ...] = ()
    tiebreaker: str | None = None
    newest_version_wins: bool = False
    read_options: dict[str, str] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.schema}.{self.table}"

    @property
    def source(self) -> str:
        return f"system.{self.name}"

    @property
    def time_column(self) -> str | None:
        """What freshness and the stored high-water mark go by."""
        return self.tiebreaker


#: Stands for a key that the run's parameter request_key names.
REQUEST_KEY = "<request_key>"
#: The read option of tables that come in the other wire format.
WIRE = {"responseFormat": "delta"}


def keys_of(spec: TableSpec, request_key: str | None = None) -> list[str]:
    """The spec's natural keys as columns; raises KeyError if one is left to the run and the run doesn't name it."""
    if REQUEST_KEY in spec.natural_keys and not request_key:
        raise KeyError(f"{spec.name}: the run's parameter request_key has to name its key")
    return [request_key if k == REQUEST_KEY else k for k in spec.natural_keys]


# Natural keys and tiebreakers of the streamed tables; which of them keep the newest version; wire formats.
STREAMED = [
    TableSpec("access", "audit", STREAM, ("event_id",), "event_time"),
    TableSpec("access", "column_lineage", STREAM, ("record_id",), "event_time"),
    TableSpec("access", "table_lineage", STREAM, ("record_id",), "event_time"),
    TableSpec("access", "clean_room_events", STREAM, ("event_id",), "event_time"),
    TableSpec("access", "inbound_network", STREAM, ("event_id",), "event_time", read_options=WIRE),
    TableSpec("access", "outbound_network", STREAM, ("event_id",), "event_time"),
    TableSpec("billing", "usage", STREAM, ("record_id",), "usage_date"),
    TableSpec("serving", "endpoint_usage", STREAM, (REQUEST_KEY,), "request_time"),
    TableSpec("sharing", "materialization_history", STREAM, ("sharing_materialization_id",), "created_at"),
    TableSpec("mlflow", "run_metrics_history", STREAM, ("record_id",), "insert_time"),
    TableSpec("mlflow", "experiments_latest", STREAM, ("workspace_id", "experiment_id"), "update_time", newest_version_wins=True),
    TableSpec("mlflow", "runs_latest", STREAM, ("workspace_id", "run_id"), "update_time", newest_version_wins=True),
    TableSpec("compute", "clusters", STREAM, ("workspace_id", "cluster_id", "change_time"), "change_time"),
    TableSpec("compute", "warehouses", STREAM, ("workspace_id", "warehouse_id", "change_time"), "change_time"),
    TableSpec("lakeflow", "jobs", STREAM, ("workspace_id", "job_id", "change_time"), "change_time"),
    TableSpec("lakeflow", "job_tasks", STREAM, ("workspace_id", "job_id", "task_key", "change_time"), "change_time"),
    TableSpec("lakeflow", "pipelines", STREAM, ("workspace_id", "pipeline_id", "change_time"), "change_time"),
    TableSpec("serving", "served_entities", STREAM, ("served_entity_id", "change_time"), "change_time"),
    TableSpec("lakeflow", "job_run_timeline", STREAM, ("workspace_id", "run_id", "period_start_time"), "period_start_time"),
    TableSpec("lakeflow", "job_task_run_timeline", STREAM, ("workspace_id", "run_id", "period_start_time"), "period_start_time"),
    TableSpec("lakeflow", "pipeline_update_timeline", STREAM, ("workspace_id", "update_id", "period_start_time"), "period_start_time", read_options=WIRE),
    TableSpec("compute", "warehouse_events", STREAM, ("workspace_id", "warehouse_id", "event_type", "event_time"), "event_time"),
    TableSpec("marketplace", "listing_funnel_events", STREAM, ("listing_id", "event_type", "event_time", "consumer_cloud", "consumer_region"), "event_time"),
    TableSpec("marketplace", "listing_access_events", STREAM, ("listing_id", "event_type", "event_time", "consumer_email"), "event_time"),
    TableSpec("compute", "node_timeline", STREAM, ("cluster_id", "instance_id", "start_time"), "start_time"),
    TableSpec("lakeflow", "zerobus_stream", STREAM, ("stream_id",), "event_time", newest_version_wins=True, read_options=WIRE),
    TableSpec("lakeflow", "zerobus_ingest", STREAM, ("stream_id", "commit_version"), "commit_time", read_options=WIRE),
]
# Keys and high-water-mark columns of the merged tables.
MERGED = [
    TableSpec("query", "history", WATERMARK, ("statement_id",), "end_time"),
    TableSpec("data_classification", "results", WATERMARK, ("catalog_name", "schema_name", "table_name", "column_name", "class_tag"), "latest_detected_time"),
    TableSpec("access", "assistant_events", WATERMARK, ("event_id",), "event_time"),
    TableSpec("storage", "predictive_optimization_operations_history", WATERMARK, ("operation_id",), "start_time"),
]
# The tables that are replaced outright.
REPLACED = [
    TableSpec("billing", "list_prices", OVERWRITE),
    TableSpec("billing", "account_prices", OVERWRITE),
    TableSpec("billing", "cloud_infra_cost", OVERWRITE),
    TableSpec("compute", "node_types", OVERWRITE),
    TableSpec("access", "workspaces_latest", OVERWRITE),
    TableSpec("data_quality_monitoring", "table_results", OVERWRITE),
]


def builtin() -> list[TableSpec]:
    """The tables the engine knows."""
    return [*STREAMED, *MERGED, *REPLACED]
