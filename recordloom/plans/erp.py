"""Brewery ERP: records with reference objects, children, and records hidden from the lists."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recordloom.operators.relate import Reference
from recordloom.plans.base import shred_entity
from recordloom.spec import Child, Entity, Policy, TableSpec

# Tables by the way they are read; all are keyed by ``id``.
FULL = """
business_details sites locations users order_adjustment_lines customers_suppliers contacts customer_types
customer_delivery_windows credit_notes credit_note_lines credit_note_allocations customer_payments tax_rates deals
crm_activities crm_activity_types products stock_items stock_received inventory_receipts purchase_orders
supplier_invoices container_types nr_container_brands goods_in_document_pools fulfillments drinks drink_batches
ingredient_batches ingredient_batch_stock_items_used fermentation_readings vessels planned_packagings
"""
CREATED = {
    "drink_batch_actions": "created_on",
    "drink_batch_stock_items_used": "created_at",
    "ingredient_batch_actions": "created_at",
}
MODIFIED = {"orders": "last_modified_at"}
BY_ORDER = ("order_lines", "payments")
# Arrays that become tables (with key and parent column), and arrays that other tables cover.
CHILDREN = {
    "orders": (("payments_refunds", "order_payments_refunds", "order_id", ("id",)),),
    "products": (
        ("component_drinks", "product_component_drinks", "product_id", ("product_id", "drink_id", "container_type_id")),
        ("component_stock_items", "product_component_stock_items", "product_id", ("product_id", "stock_item_id")),
    ),
    "purchase_orders": (("entries", "purchase_order_entries", "purchase_order_id", ("id",)),),
}
REDUNDANT = {
    "orders": ("order_lines", "adjustment_lines"),
    "customers_suppliers": ("contacts",),
    "customer_payments": ("order_allocations",),
}
# Columns that refer to tables whose lists are incomplete.
RECOVERABLE = {
    "customers_suppliers": ("customer_id", "parent_company_id"),
    "users": (
        "created_by_id", "sales_person_id", "updater_id", "approver_id", "rejecter_id", "canceler_id", "deleter_id",
        "completed_by_id",
    ),
    "stock_items": ("stock_item_id",),
    "container_types": ("container_type_id",),
}


def _specs() -> dict[str, TableSpec]:
    specs = {n: TableSpec(n, ("id",)) for n in FULL.split()}
    specs |= {n: TableSpec(n, ("id",), policy=Policy.CREATED, cursor=(c,)) for n, c in CREATED.items()}
    specs |= {n: TableSpec(n, ("id",), policy=Policy.MODIFIED, cursor=(c,)) for n, c in MODIFIED.items()}
    specs |= {n: TableSpec(n, ("id",), policy=Policy.BY_PARENT) for n in BY_ORDER}
    for children in CHILDREN.values():
        specs |= {table: TableSpec(table, pk) for _, table, _, pk in children}
    return specs


SPECS: dict[str, TableSpec] = _specs()


def shred(table: str, records: DataFrame) -> dict[str, DataFrame]:
    """Tables of one kind of record: references exploded, children apart, redundant copies dropped."""
    children = tuple(Child(array, name, (("id", fk),)) for array, name, fk, _ in CHILDREN.get(table, ()))
    entity = Entity(SPECS[table], "fk", drop=REDUNDANT.get(table, ()), children=children)
    return shred_entity(entity, records, SPECS)


def find_references(tables: dict[str, DataFrame]) -> list[Reference]:
    """Every column of the given tables that refers to a recoverable table."""
    targets = {c: target for target, columns in RECOVERABLE.items() for c in columns}
    return [
        Reference(name, c, targets[c]) for name, df in tables.items() for c in df.columns if c in targets
    ]
