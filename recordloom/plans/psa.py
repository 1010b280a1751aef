"""Professional services: JSON:API records, one table per resource, and the feed of deleted items."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recordloom.operators.flatten import flatten_jsonapi, strip_nulls
from recordloom.spec import Policy, TableSpec

# Resources by the way they are read; every table is keyed by ``id``.
MODIFIED = """
time_entry_versions bookings services activities salaries people companies tasks deals invoices payments expenses
"""
FULL = """
users projects boards task_lists task_dependencies contracts invoice_attributions line_items memberships comments
attachments contact_entries pages page_versions dashboards filters prices entitlements timers timesheets overheads
revenue_distributions placeholders purchase_orders bills todos discussions proposals emails deleted_items surveys
survey_fields survey_field_options survey_responses resource_requests pulses widgets
"""
REFERENCE = """
organizations subsidiaries custom_fields custom_field_options custom_field_sections tags service_types deal_statuses
lost_reasons workflows workflow_statuses pipelines events holiday_calendars holidays document_types document_styles
approval_policies approval_workflows approval_policy_assignments rate_cards tax_rates exchange_rates bank_accounts
invoice_templates automatic_invoicing_rules payment_reminders payment_reminder_sequences deal_cost_rates kpd_codes
report_categories service_assignments service_type_assignments time_tracking_policies teams team_memberships sections
folders organization_memberships integration_exporter_configurations integrations
"""
TRAILING_DAYS = {"time_entries": 90}

# Resources whose deletion is reported in the feed, by their plural name.
DELETABLE = """
tasks projects deals companies people invoices services bookings time_entries expenses comments boards task_lists
payments line_items contact_entries users custom_fields custom_field_options deal_statuses document_types events
lost_reasons organizations pipelines service_types subsidiaries workflows workflow_statuses salaries contracts
attachments memberships entitlements pages todos discussions proposals purchase_orders bills timers placeholders emails
surveys resource_requests widgets filters dashboards overheads prices
"""


def singular(name: str) -> str:
    """Singular of a resource name."""
    if name == "people":
        return "person"
    if name.endswith("ies"):
        return name[:-3] + "y"
    return name[:-2] if name.endswith("uses") else name[:-1]


DELETE_ROUTING = {form: name for name in DELETABLE.split() for form in (name, singular(name))}


def _spec(name: str, policy: Policy, **more) -> TableSpec:
    return TableSpec(name, ("id",), policy=policy, sparse=True, **more)


SPECS: dict[str, TableSpec] = {
    **{n: _spec(n, Policy.MODIFIED, cursor=("updated_at", "created_at")) for n in MODIFIED.split()},
    **{n: _spec(n, Policy.WINDOW, cursor=("date",), window_days=d) for n, d in TRAILING_DAYS.items()},
    **{n: _spec(n, Policy.FULL) for n in (FULL + REFERENCE).split()},
}


def shred(table: str, records: DataFrame) -> dict[str, DataFrame]:
    """Records of one resource to its sparse row set."""
    return {table: strip_nulls(flatten_jsonapi(records), SPECS[table].pk)}
