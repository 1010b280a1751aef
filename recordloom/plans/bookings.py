"""Bookings: workspaces, services and staff with their assignments, appointments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.flatten import flatten_record
from recordloom.operators.keys import require_key
from recordloom.operators.relate import scope_filter
from recordloom.operators.shred import bridge
from recordloom.spec import Policy, TableSpec, parse_tables

# Tables and their keys.
SPECS: dict[str, TableSpec] = parse_tables(
    """
    workspaces: id
    services: id
    staff: id
    resources: id
    service_staff_assignments: service_id, staff_id
    service_workspace_assignments: service_id, workspace_id
    staff_service_assignments: staff_id, service_id
    staff_workspace_assignments: staff_id, workspace_id
    """
) | {
    "appointments": TableSpec(
        "appointments", ("booking_id",), policy=Policy.WINDOW, cursor=("start_time",), window_days=365, future_days=365
    )
}

ARRAYS = ("assigned_staffs", "assigned_services", "assigned_workspace", "assigned_workspaces")


def _require_id(records: DataFrame) -> DataFrame:
    return require_key(records, ["id"])[0]


def shred_services(services: DataFrame, queried: str = "workspace_id") -> dict[str, DataFrame]:
    """Services and their bridges. ``queried`` is the workspace that each record was read under."""
    services = _require_id(services)
    out = {"services": flatten_record(services, "display", drop=[*ARRAYS, queried])}
    if "assigned_staffs" in services.columns:
        out["service_staff_assignments"] = bridge(services, "id", "assigned_staffs", "staff_id", a_as="service_id")
    with_list = services if "assigned_workspaces" in services.columns else services.withColumn(
        "assigned_workspaces", F.lit(None).cast("array<string>")
    )
    singular = "assigned_workspace" if "assigned_workspace" in services.columns else None
    out["service_workspace_assignments"] = bridge(
        with_list, "id", "assigned_workspaces", "workspace_id", a_as="service_id", singular=singular, scope=queried
    )
    return out


def shred_staff(staff: DataFrame, queried: str = "workspace_id") -> dict[str, DataFrame]:
    staff = _require_id(staff)
    out = {"staff": flatten_record(staff, "display", drop=[*ARRAYS, queried])}
    if "assigned_services" in staff.columns:
        out["staff_service_assignments"] = bridge(staff, "id", "assigned_services", "service_id", a_as="staff_id")
    with_list = staff if "assigned_workspaces" in staff.columns else staff.withColumn(
        "assigned_workspaces", F.lit(None).cast("array<string>")
    )
    out["staff_workspace_assignments"] = bridge(
        with_list, "id", "assigned_workspaces", "workspace_id", a_as="staff_id", scope=queried
    )
    return out


def shred_plain(table: str, records: DataFrame, workspaces: list[str] | None = None) -> dict[str, DataFrame]:
    """Workspaces (only the wanted ones) and resources."""
    rows = _require_id(records)
    if workspaces:
        rows = rows.filter(F.col("id").cast("string").isin(*workspaces))
    return {table: flatten_record(rows, "display")}


def shred_appointments(records: DataFrame, workspaces: list[str] | None = None) -> dict[str, DataFrame]:
    """Appointments of the wanted workspaces; the customer block becomes columns, rows without a key are left out."""
    rows = scope_filter(records, "workspace_id", workspaces or []) if "workspace_id" in records.columns else records
    flat = flatten_record(rows, "display", spread=["customer_more_info"])
    if "booking_id" not in flat.columns and "id" in flat.columns:
        flat = flat.withColumn("booking_id", F.col("id"))
    return {"appointments": require_key(flat, ["booking_id"])[0]}
