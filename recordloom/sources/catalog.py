"""Which tables exist, read from landed metadata documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.scalars import first_truthy

# Fixed value: type code of a nested form.
SUBFORM_TYPE_CODE = "19"


def _name_part(c: Column) -> Column:
    """Row-side twin of the table name rule, for names that are themselves data."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def report_table(workspace: Column, app: Column, report: Column) -> Column:
    return F.concat(
        F.lit("data_"), F.concat_ws("__", _name_part(workspace), _name_part(app), _name_part(report))
    )


def discover_reports(apps: DataFrame) -> DataFrame:
    """Report list of a form builder.

    ``apps``: ``workspace, link_name, reports array<struct<link_name,display_name,type>>``.
    Entries without a link name are left out, and so are page reports, which hold no records.
    """
    report = F.col("r")
    return (
        apps.filter(F.coalesce(F.col("link_name"), F.lit("")) != "")
        .select("workspace", F.col("link_name").alias("app_link_name"), F.explode("reports").alias("r"))
        .filter(F.coalesce(report["link_name"], F.lit("")) != "")
        .filter(~F.coalesce(F.lower(report["type"].cast("string")).contains("page"), F.lit(False)))
        .select(
            "workspace",
            "app_link_name",
            report["link_name"].alias("link_name"),
            report["display_name"].alias("display_name"),
            report_table(F.col("workspace"), F.col("app_link_name"), report["link_name"]).alias("table"),
        )
    )


def discover_forms(forms: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Form list of an HR system with the view to read each form through.

    ``forms``: ``link_name, display_name, views array<struct<view_name,is_default>>``.
    The view is the first flagged one, else the first one, else ``<link_name>View``.
    """
    named = F.filter("views", lambda v: F.coalesce(v["view_name"], F.lit("")) != "")
    flagged = F.filter(named, lambda v: F.coalesce(v["is_default"], F.lit(False)))
    view = F.coalesce(
        F.get(flagged, F.lit(0))["view_name"],
        F.get(named, F.lit(0))["view_name"],
        F.concat(F.col("link_name"), F.lit("View")),
    )
    kept = forms.filter(F.coalesce(F.col("link_name"), F.lit("")) != "")
    if skip:
        kept = kept.filter(~F.col("link_name").isin(*skip))
    return kept.select(
        F.col("link_name").alias("form_link_name"),
        "display_name",
        view.alias("default_view"),
        F.concat(F.lit("form_"), _name_part(F.col("link_name"))).alias("table"),
    )


def is_subform(type_: Column) -> Column:
    """Type code of a nested form, or a type text that says so."""
    text = type_.cast("string")
    return F.coalesce((text == SUBFORM_TYPE_CODE) | F.lower(text).contains("subform"), F.lit(False))


def catalog_tables(apps: DataFrame) -> dict[str, DataFrame]:
    """Applications, forms, fields, nested-form fields and reports as tables, each with its raw JSON.

    ``apps``: ``workspace, link_name, display_name, category,
    forms array<struct<link_name,display_name,type,fields array<struct<link_name,display_name,type>>>>,
    reports array<struct<link_name,display_name,type>>``.
    """
    apps = apps.filter(F.coalesce(F.col("link_name"), F.lit("")) != "")
    plain = [c for c in apps.columns if c not in ("forms", "reports", "workspace")]
    applications = apps.select(
        "workspace", "link_name", "display_name", "category", F.to_json(F.struct(*plain)).alias("raw_meta")
    )
    form = F.col("f")
    forms_ = apps.select(
        "workspace", F.col("link_name").alias("app_link_name"), F.explode("forms").alias("f")
    ).filter(F.coalesce(form["link_name"], F.lit("")) != "")
    forms = forms_.select(
        "workspace",
        "app_link_name",
        form["link_name"].alias("link_name"),
        form["display_name"].alias("display_name"),
        form["type"].alias("type"),
        F.to_json(form.dropFields("fields")).alias("raw_meta"),
    )
    field = F.col("d")
    fields_ = forms_.select(
        "workspace",
        "app_link_name",
        form["link_name"].alias("form_link_name"),
        F.explode(form["fields"]).alias("d"),
    ).filter(F.coalesce(first_truthy(field["link_name"]), F.lit("")) != "")
    fields = fields_.select(
        "workspace",
        "app_link_name",
        "form_link_name",
        field["link_name"].alias("link_name"),
        field["display_name"].alias("display_name"),
        field["type"].alias("type"),
        F.to_json(field).alias("raw_meta"),
    )
    report = F.col("r")
    reports = (
        apps.select("workspace", F.col("link_name").alias("app_link_name"), F.explode("reports").alias("r"))
        .filter(F.coalesce(report["link_name"], F.lit("")) != "")
        .select(
            "workspace",
            "app_link_name",
            report["link_name"].alias("link_name"),
            report["display_name"].alias("display_name"),
            report["type"].alias("type"),
            report_table(F.col("workspace"), F.col("app_link_name"), report["link_name"]).alias("table"),
            F.to_json(report).alias("raw_meta"),
        )
    )
    return {
        "applications": applications,
        "forms": forms,
        "form_fields": fields,
        "subform_fields": fields.filter(is_subform(F.col("type"))).drop("type", "raw_meta"),
        "reports": reports,
    }
