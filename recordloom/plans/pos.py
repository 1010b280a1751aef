"""Point of sale: order documents, labour, cash, configuration, menus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.flatten import (
    VOID_PATHS,
    apply_types,
    flatten_prefix,
    json_rest,
    project_deep,
    promote,
)
from recordloom.operators.shred import Node, bridge, payment_junction, shred_tree, walk_tree
from recordloom.plans.base import typed_specs
from recordloom.spec import TableSpec, parse_tables
from recordloom.store import cut_lineage

VOIDED_PAYMENT = VOID_PATHS

# Which arrays of an order become tables and which objects are spread.
_DISCOUNT_SPREAD = ("approver", "appliedDiscountReason", "discount")

ORDER_TREE = Node(
    "orders",
    spread=("server", "createdDevice", "lastModifiedDevice"),
    extract=(
        ("diningOption", "guid", "diningOption_guid"),
        ("table", "guid", "table_guid"),
        ("serviceArea", "guid", "serviceArea_guid"),
        ("revenueCenter", "guid", "revenueCenter_guid"),
    ),
    drop=("pricingFeatures",),
    children=(
        Node(
            "orders_check",
            "checks",
            spread=("customer", "createdDevice", "lastModifiedDevice"),
            drop=("payments",),
            children=(
                Node(
                    "orders_check_selection",
                    "selections",
                    spread=("salesCategory", "itemGroup", "item", "diningOption", "refundDetails", "voidReason"),
                    children=(
                        Node(
                            "orders_check_selection_applied_tax",
                            "appliedTaxes",
                            spread=("taxRate",),
                            derived_key=("orders_check_selection_id", "taxRate_id", "name", "rate"),
                        ),
                        Node(
                            "orders_check_selection_modifier",
                            "modifiers",
                            spread=(
                                "diningOption", "item", "itemGroup", "optionGroup",
                                "salesCategory", "preModifier", "voidReason",
                            ),
                        ),
                        Node(
                            "orders_check_selection_applied_discount",
                            "appliedDiscounts",
                            spread=_DISCOUNT_SPREAD,
                            children=(
                                Node("orders_check_selection_applied_discount_combo_item", "comboItems"),
                                Node("orders_check_selection_applied_discount_trigger", "triggers", spread=("selection",)),
                            ),
                        ),
                    ),
                ),
                Node(
                    "orders_check_applied_discount",
                    "appliedDiscounts",
                    spread=_DISCOUNT_SPREAD,
                    children=(
                        Node("orders_check_applied_discount_combo_item", "comboItems"),
                        Node("orders_check_applied_discount_trigger", "triggers", spread=("selection",)),
                    ),
                ),
                Node(
                    "orders_check_applied_service_charge",
                    "appliedServiceCharges",
                    spread=("serviceCharge",),
                    children=(Node("orders_check_applied_service_charge_applied_tax", "appliedTax"),),
                ),
            ),
        ),
    ),
)

# Tables and their keys.
SPECS_TEXT = """
restaurant: id
job: id, restaurant_id
shift: id, restaurant_id
employee: id, restaurant_id
employee_job_reference: id, employee_id
employee_wage_override: id, employee_id
time_entry: id, restaurant_id
break: id
cash_deposit: id, restaurant_id
cash_entry: id, restaurant_id
alternate_payment_types: id, restaurant_id
dining_option: id, restaurant_id
discounts: id, restaurant_id
menu: id, restaurant_id
menu_group: id, restaurant_id
menu_item: id, restaurant_id
restaurant_service: id, restaurant_id
revenue_center: id, restaurant_id
sale_category: id, restaurant_id
service_area: id, restaurant_id
tables: id, restaurant_id
orders: id
orders_check: id, restaurant_id
orders_check_applied_discount: id, restaurant_id
orders_check_applied_discount_combo_item: id, restaurant_id
orders_check_applied_discount_trigger: orders_check_applied_discount_id, restaurant_id, selection_id
orders_check_applied_service_charge: id, orders_check_id, restaurant_id
orders_check_applied_service_charge_applied_tax: id, orders_check_applied_service_charge_id, restaurant_id
orders_check_payment: orders_check_id, payment_id, orders_id, restaurant_id
orders_check_selection: id, orders_check_id, restaurant_id
orders_check_selection_applied_discount: id, restaurant_id
orders_check_selection_applied_discount_combo_item: id, restaurant_id
orders_check_selection_applied_discount_trigger: orders_check_selection_applied_discount_id, restaurant_id, selection_id
orders_check_selection_applied_tax: id, orders_check_selection_id, restaurant_id
orders_check_selection_modifier: id, orders_check_selection_id, restaurant_id
orders_pricing_feature: orders_id, pricing_feature, restaurant_id
payment: id, restaurant_id
tax_rate: id, restaurant_id
void_reason: id, restaurant_id
service_charge: id, restaurant_id
break_type: id, restaurant_id
no_sale_reason: id, restaurant_id
printer: id, restaurant_id
premodifier_group: id, restaurant_id
premodifier: id, restaurant_id
cash_drawer: id, restaurant_id
restaurant_detail: restaurant_id
tip_withholding: restaurant_id
menu_v2: restaurant_id
menu_v2_menu: id, restaurant_id
menu_v2_menu_group: id, restaurant_id
menu_v2_menu_item: id, restaurant_id
menu_v2_modifier_group: reference_id, restaurant_id
menu_v2_modifier_option: reference_id, restaurant_id
menu_v2_premodifier_group: reference_id, restaurant_id
menu_v2_item_modifier_group_ref: menu_item_id, modifier_group_reference_id, restaurant_id
inventory: id, restaurant_id
"""
# Tables whose rows carry a deletion flag.
FLAGGED = (
    "restaurant", "orders", "job", "employee", "shift", "time_entry", "break", "orders_check",
    "orders_check_applied_discount", "orders_check_applied_discount_combo_item", "orders_check_applied_discount_trigger",
    "orders_check_applied_service_charge", "orders_check_selection", "orders_check_selection_applied_discount",
    "orders_check_selection_applied_discount_trigger", "orders_check_selection_applied_tax", "orders_check_selection_modifier",
)
# Column types of the domain.
TIMES = """
closedDate createdDate date deletedDate estimatedFulfillmentDate inDate lastUpdated modifiedDate openedDate outDate
paidDate promisedDate refundDate voidDate void_info_date
"""
FLAGS = """
active allowsDuplicates auditResponse autoClockedOut createdInTestMode curbside deferred deleted delivery dineIn
excessFood excludeFromReporting gratuity inheritOptionGroups inheritUnitOfMeasure isComboParent isDefault isDeferred
isDiscountable missed nonExclusive takeout taxExempt taxable tipped voided
"""
# Objects of configuration, labour and cash records, and how they are taken apart.
EXTRACT = {
    "menu_group": (("menu", "guid", "menu_id"),),
    "service_area": (("revenueCenter", "guid", "revenue_center_guid"),),
    "tables": (("revenueCenter", "guid", "revenue_center_guid"), ("serviceArea", "guid", "service_area_guid")),
    "shift": (("employeeReference", "guid", "employee_reference_id"), ("jobReference", "guid", "job_reference_id")),
    "time_entry": (
        ("employeeReference", "guid", "employee_reference_id"), ("jobReference", "guid", "job_reference_id"),
        ("shiftReference", "guid", "shift_reference_id"),
    ),
}
SPREAD = {
    "cash_deposit": ("employee", "creator"),
    "cash_entry": (
        "approverOrShiftReviewSubject", "creatorOrShiftReviewSubject", "cashDrawer", "employee1", "employee2",
        "payoutReason", "noSaleReason",
    ),
    "shift": ("scheduleConfig",),
    "payment": ("cashDrawer", "createdDevice", "lastModifiedDevice", "otherPayment", "refund", "server"),
}
LABOUR_CHILDREN = {
    "time_entry": (Node("break", "breaks", spread=("breakType",)),),
    "employee": (
        Node("employee_job_reference", "jobReferences"),
        Node("employee_wage_override", "wageOverrides", spread=("jobReference",)),
    ),
}
PROMOTED = ("general", "location")
MENU_REFERENCES = {
    "modifierGroupReferences": "menu_v2_modifier_group",
    "modifierOptionReferences": "menu_v2_modifier_option",
    "preModifierGroupReferences": "menu_v2_premodifier_group",
}

SPECS: dict[str, TableSpec] = typed_specs(
    [
        TableSpec(**{**s.__dict__, "delete_flag": "deleted" if s.name in FLAGGED else None})
        for s in parse_tables(SPECS_TEXT).values()
    ],
    {**dict.fromkeys(TIMES.split(), "timestamp"), **dict.fromkeys(FLAGS.split(), "boolean")},
)


def _typed(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: apply_types(df, SPECS[name]) if name in SPECS else df for name, df in tables.items()}


def shred_orders(orders: DataFrame, tenant: str = "restaurant_id") -> dict[str, DataFrame]:
    """Landed order documents to every table they feed. Land them as Parquet before writing several."""
    out = shred_tree(orders, ORDER_TREE, tenant)
    junction, payments = payment_junction(orders, tenant)
    out["orders_check_payment"] = junction
    flat = project_deep(payments, VOIDED_PAYMENT, drop=["voidInfo"])
    out["payment"] = json_rest(flatten_prefix(flat, SPREAD["payment"]))
    if "pricingFeatures" in orders.columns:
        out["orders_pricing_feature"] = bridge(
            orders, "guid", "pricingFeatures", "pricing_feature", a_as="orders_id", carry=[tenant]
        )
    return _typed(out)


def shred_config(table: str, records: DataFrame, tenant: str = "restaurant_id") -> dict[str, DataFrame]:
    """Configuration, labour and cash records and their children."""
    root = Node(table, spread=SPREAD.get(table, ()), extract=EXTRACT.get(table, ()), children=LABOUR_CHILDREN.get(table, ()))
    return _typed(shred_tree(records, root, tenant))


def shred_detail(table: str, records: DataFrame) -> dict[str, DataFrame]:
    """One object per restaurant: scalars first, then the promoted sections, the rest as JSON."""
    sections = PROMOTED if table == "restaurant_detail" else ()
    return _typed({table: promote(records, sections)})


def shred_menus(pages: DataFrame, tenant: str = "restaurant_id", menu: str = "menu") -> dict[str, DataFrame]:
    """Published menu trees (``tenant`` and a VARIANT) to menus, groups of any depth, items and references."""
    doc = F.col(menu)

    def text(of: str, path: str):
        return F.try_variant_get(of, f"$.{path}", "string")

    def rest(of: str, without: tuple[str, ...]):
        """The object as a map of JSON texts without the arrays that have tables of their own."""
        fields = F.try_variant_get(of, "$", "map<string,variant>")
        kept = F.map_filter(fields, lambda k, v: ~k.isin(*without))
        return F.transform_values(kept, lambda k, v: F.to_json(v))

    menus = pages.select(tenant, F.explode(F.try_variant_get(doc, "$.menus", "array<variant>")).alias("m"))
    menus = cut_lineage(menus)
    groups = walk_tree(
        menus.withColumn("menu_id", text("m", "guid")),
        F.try_variant_get("m", "$.menuGroups", "array<variant>"),
        "menuGroups",
        [tenant, "menu_id"],
    )
    items = groups.select(
        tenant,
        text("node", "guid").alias("menu_group_id"),
        F.explode(F.try_variant_get("node", "$.menuItems", "array<variant>")).alias("i"),
    )
    out = {
        "menu_v2": pages.select(
            tenant, *[text(menu, n).alias(n) for n in ("restaurantGuid", "lastUpdated", "restaurantTimeZone")]
        ),
        "menu_v2_menu": menus.select(tenant, text("m", "guid").alias("id"), rest("m", ("menuGroups", "guid")).alias("fields")),
        "menu_v2_menu_group": groups.select(
            tenant,
            text("node", "guid").alias("id"),
            "menu_id",
            text("parent", "guid").alias("parent_menu_group_id"),
            rest("node", ("menuGroups", "menuItems", "guid")).alias("fields"),
        ),
        "menu_v2_menu_item": items.select(
            tenant, text("i", "guid").alias("id"), "menu_group_id", rest("i", ("modifierGroupReferences", "guid")).alias("fields")
        ),
        "menu_v2_item_modifier_group_ref": items.select(
            tenant,
            text("i", "guid").alias("menu_item_id"),
            F.explode(F.try_variant_get("i", "$.modifierGroupReferences", "array<string>")).alias("modifier_group_reference_id"),
        ).distinct(),
    }
    for key, name in MENU_REFERENCES.items():
        entries = pages.select(
            tenant, F.explode(F.try_variant_get(doc, f"$.{key}", "map<string,variant>")).alias("reference_id", "r")
        ).filter(F.schema_of_variant("r").startswith("OBJECT"))
        out[name] = entries.select(tenant, "reference_id", text("r", "guid").alias("id"), rest("r", ("guid",)).alias("fields"))
    return out


def widen_fields(df: DataFrame, names: list[str], column: str = "fields") -> DataFrame:
    """Chosen entries of the ``fields`` map as columns; JSON text of scalars is unquoted."""
    def value(name: str):
        json = F.col(column)[name]
        return F.when(json.startswith('"'), F.try_variant_get(F.try_parse_json(json), "$", "string")).otherwise(json)

    return df.select(*[c for c in df.columns if c != column], *[value(n).alias(n) for n in names])
