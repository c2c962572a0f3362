"""Bulk copies of table lists between any two Spark data sources."""

from tableferry.config import (
    ConfigError,
    OnEmpty,
    SaveMode,
    TableSpec,
    TransferConfig,
    TypesRelation,
    Verify,
    config_report,
    from_settings,
    from_spark_conf,
)
from tableferry.plans.report import RunReport, TableOutcome, TransferFailed, run_totals
from tableferry.plans.run import run
from tableferry.plans.transfer import SinkNotEmpty, transfer_table

__all__ = [
    "ConfigError",
    "OnEmpty",
    "RunReport",
    "SaveMode",
    "SinkNotEmpty",
    "TableOutcome",
    "TableSpec",
    "TransferConfig",
    "TransferFailed",
    "TypesRelation",
    "Verify",
    "config_report",
    "from_settings",
    "from_spark_conf",
    "run",
    "run_totals",
    "transfer_table",
]
