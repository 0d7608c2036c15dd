"""Dimension tables from any batch source."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession

from haulwatch.operators.sequence import ensure_checkpoint_dir

# Dimension tables by short name.
TABLES = {
    "vehicle": "dim_cwp_d_vehicle_info",
    "service_fee": "ods_cwp_vehicle_service_fee",
    "driver": "dim_cwp_d_driver_info",
    "enterprise": "dim_cwp_d_enterprise_info",
    "transport_card": "ods_cwp_vehicle_transport_card",
    "area_coords": "dim_cwp_area_coords",
    "register_card": "ods_cwp_vehicle_register_card",
    "build_site": "dim_cwp_d_build_site_info",
    "disposal_site": "dim_cwp_d_disposal_site_info",
    "fence": "dim_cwp_boundary_condition",
    "rule_work_time": "dim_cwp_boundary_condition_work_time",
    "rule_restricted": "dim_cwp_boundary_condition_penalty_fence",
    "rule_over_speed": "dim_cwp_boundary_condition_over_speed",
    "rule_document_control": "dim_cwp_boundary_condition_document_control",
    "illegal_type": "ods_cwp_credit_illegal_type_dept_set",
    "vehicle_status": "dwd_h_cwp_vehicle_state_card_info",
}


class Dims:
    """Loads dimensions as DataFrames.

    With ``max_age`` seconds, ``load`` hands out the same snapshot until it is that old. A snapshot is a copy in the
    checkpoint folder, so a running query does not depend on files that somebody rewrites. Without it, the table itself is
    handed out: fit for one batch, or for a source that can be read again at any time (JDBC).
    ``table_options`` adds reader options for single tables, such as a JDBC ``partitionColumn`` with its bounds.
    """

    def __init__(self, spark: SparkSession, fmt: str = "parquet", options: dict[str, str] | None = None,
                 root: str | None = None, max_age: float | None = None, clock=time.monotonic,
                 table_options: dict[str, dict[str, str]] | None = None):
        self.spark, self.fmt, self.options, self.root = spark, fmt, options or {}, root
        self.table_options = table_options or {}
        self.max_age, self.clock = max_age, clock
        self._snapshots: dict[str, tuple[float, DataFrame]] = {}

    def load(self, name: str) -> DataFrame:
        if self.max_age is None:
            return self._read(name)
        now = self.clock()
        held = self._snapshots.get(name)
        if held is None or now - held[0] >= self.max_age:
            ensure_checkpoint_dir(self.spark)
            held = (now, self._read(name).checkpoint())
            self._snapshots[name] = held
        return held[1]

    def _read(self, name: str) -> DataFrame:
        table = TABLES.get(name, name)
        reader = self.spark.read.format(self.fmt).options(**self.options, **self.table_options.get(name, {}))
        if self.fmt == "jdbc":
            return reader.option("dbtable", table).load()
        if self.root is not None:
            return reader.load(f"{self.root.rstrip('/')}/{table}")
        return self.spark.table(table)
