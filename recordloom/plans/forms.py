"""Form builder: tables are found at run time, one per report and one per nested form."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recordloom.operators.flatten import flatten_record
from recordloom.operators.shred import auto_children
from recordloom.spec import Policy, TableSpec, parse_tables

# Metadata tables and their keys.
SPECS: dict[str, TableSpec] = parse_tables(
    """
    applications: workspace, link_name
    forms: workspace, app_link_name, link_name
    reports: workspace, app_link_name, link_name
    form_fields: workspace, app_link_name, form_link_name, link_name
    subform_fields: workspace, app_link_name, form_link_name, link_name
    """
)


def report_spec(table: str) -> TableSpec:
    """Spec of a report's records."""
    return TableSpec(table, ("id",), policy=Policy.MODIFIED, cursor=("modified_time", "added_time"))


def shred(table: str, records: DataFrame) -> dict[str, DataFrame]:
    """Parent rows and the nested forms of one report's records."""
    if "ID" not in records.columns:
        return {table: flatten_record(records, "forms")}
    return auto_children(records, table)
