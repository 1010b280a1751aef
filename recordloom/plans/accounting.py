"""Accounting: documents with line items, tracking and allocations; settings; files; projects; reports."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.operators.flatten import split_row, strip_nulls
from recordloom.operators.merge import DELETED_STATUSES
from recordloom.operators.shred import flatten_report, report_cells, report_runs, trial_balance
from recordloom.plans.base import TRACKING, pick_columns, shred_entity, typed_specs
from recordloom.spec import Child, Entity, Policy, TableSpec, parse_tables

# Tables and their keys.
REFERENCE_TABLES = """
accounting_organisation: OrganisationID
accounting_settings: _singleton
accounting_asset: AssetId
accounting_asset_type: AssetTypeId
accounting_branding_theme: BrandingThemeID
accounting_currency: Code
accounting_tax_rate: TaxType
accounting_tax_rate_component: TaxType, Name
accounting_tracking_category: TrackingCategoryID
accounting_tracking_option: TrackingCategoryID, TrackingOptionID
accounting_contact_group: ContactGroupID
accounting_contact_group_member: ContactGroupID, ContactID
accounting_contact_address: ContactID, AddressType
accounting_allocation: SourceID, InvoiceID, Index
accounting_journal: JournalID
accounting_journal_line: JournalID, JournalLineID
accounting_journal_line_tracking: JournalID, JournalLineID, TrackingCategoryID
accounting_report_run: ReportType, ReportDate
accounting_report_trial_balance: ReportDate, RowIndex
accounting_report_row: ReportType, ReportDate, RowIndex, CellIndex
files_file: FileId
files_association: FileId, ObjectId
files_folder: FolderId
projects_project: ProjectId
projects_task: ProjectId, TaskId
projects_time_entry: TimeEntryId
projects_project_user: UserId
"""
# Documents read by modification time, with the name of their key.
CURSOR_DOCUMENTS = {
    "account": "AccountID", "contact": "ContactID", "bank_transaction": "BankTransactionID",
    "bank_transfer": "BankTransferID", "batch_payment": "BatchPaymentID", "credit_note": "CreditNoteID",
    "employee": "EmployeeID", "expense_claim": "ExpenseClaimID", "invoice": "InvoiceID", "item": "ItemID",
    "linked_transaction": "LinkedTransactionID", "manual_journal": "ManualJournalID", "overpayment": "OverpaymentID",
    "payment": "PaymentID", "prepayment": "PrepaymentID", "purchase_order": "PurchaseOrderID", "quote": "QuoteID",
    "receipt": "ReceiptID", "repeating_invoice": "RepeatingInvoiceID", "user": "UserID",
}
# Documents with line items, and those whose status can mean that they are gone.
WITH_LINES = (
    "bank_transaction", "credit_note", "invoice", "overpayment", "prepayment", "purchase_order", "quote",
    "receipt", "repeating_invoice",
)
WITHOUT_TRACKING = ("quote",)
STATUS_DELETES = (
    "account", "contact", "bank_transaction", "credit_note", "invoice", "manual_journal", "payment",
    "purchase_order", "quote",
)
WITH_ALLOCATIONS = {"credit_note": "CreditNote", "overpayment": "Overpayment", "prepayment": "Prepayment"}
REDUNDANT = (
    "Payments", "CreditNotes", "Prepayments", "Overpayments", "Attachments", "ValidationErrors", "Warnings",
    "StatusAttributeString", "HasValidationErrors", "DateString", "DueDateString", "InvoicePaymentServices",
    "InvoiceAddresses",
)
ORGANISATION_DROPS = ("Phones", "Addresses", "ExternalLinks", "PaymentTerms", "ValidationErrors")
SETTINGS = (
    "OrganisationID", "FinancialYearEndDay", "FinancialYearEndMonth", "SalesTaxBasis", "SalesTaxPeriod",
    "BaseCurrency", "CountryCode", "Timezone", "OrganisationType",
)
# Column types of the domain.
NUMBERS = """
AccountingBookValue Amount AmountCredited AmountDue AmountPaid AppliedAmount BankAmount BatchPaymentTotalAmount
CISDeduction CISRate Credit CurrencyRate Debit Discount DiscountAmount DiscountRate DisplayTaxRate DisposalPrice
EffectiveRate EstimateAmount GrossAmount LineAmount NetAmount PurchasePrice PurchaseUnitPrice Quantity QuantityOnHand
Rate RemainingCredit SalesUnitPrice SubTotal TaxAmount Total TotalAmount TotalCostPool TotalDiscount TotalTax
TotalToBeInvoiced UnitAmount YTDCredit YTDDebit
"""
FLAGS = """
AddToWatchlist ApprovedForSending BatchPaymentIsReconciled CanApplyToAssets CanApplyToEquity CanApplyToExpenses
CanApplyToLiabilities CanApplyToRevenue CanRollback EnablePaymentsToAccount FromIsReconciled HasAccount HasAttachments
HasErrors HasValidationErrors IncludePDF IsBlank IsCustomer IsDeleted IsDemoCompany IsDiscounted IsNonRecoverable
IsPurchased IsReconciled IsSold IsSubscriber IsSupplier IsTrackedAsInventory IsCompound MarkAsSent PaysTax SendCopy
SentToContact ShowInExpenseClaims ShowOnCashBasisReports ToIsReconciled
"""
WHOLE_NUMBERS = """
CellIndex EstimateMinutes FinancialYearEndDay FinancialYearEndMonth JournalNumber MinutesToBeInvoiced RowIndex
ScheduleDueDate SchedulePeriod SortOrder TotalMinutes
"""
TYPES = {
    **dict.fromkeys(NUMBERS.split(), "double"),
    **dict.fromkeys(FLAGS.split(), "boolean"),
    **dict.fromkeys(WHOLE_NUMBERS.split(), "int"),
    "Locks": "bigint",
}


def _documents() -> list[TableSpec]:
    specs = []
    for name, key in CURSOR_DOCUMENTS.items():
        full = name == "repeating_invoice"
        specs.append(
            TableSpec(
                f"accounting_{name}",
                (key,),
                policy=Policy.FULL if full else Policy.MODIFIED,
                cursor=() if full else ("CreatedDateUTC" if name == "bank_transfer" else "UpdatedDateUTC",),
                sparse=True,
                delete_statuses=DELETED_STATUSES if name in STATUS_DELETES else (),
                status_column=("ContactStatus" if name == "contact" else "Status") if name in STATUS_DELETES else None,
            )
        )
        lines = "line" if name == "manual_journal" else "line_item"
        if name in WITH_LINES or name == "manual_journal":
            specs.append(TableSpec(f"accounting_{name}_{lines}", (key, "LineItemID"), sparse=True))
            if name not in WITHOUT_TRACKING:
                pk = (key, "LineItemID", "TrackingCategoryID")
                specs.append(TableSpec(f"accounting_{name}_{lines}_tracking", pk, sparse=True))
    return specs


SPECS: dict[str, TableSpec] = typed_specs(
    [*parse_tables(REFERENCE_TABLES, sparse=True).values(), *_documents()], TYPES
)
SPECS["accounting_journal"] = replace(SPECS["accounting_journal"], policy=Policy.MAX_ID, cursor=("JournalNumber",))

_CONTACT = (("Contact.ContactID", "ContactID"),)
_SCHEDULE = ("Period", "Unit", "DueDate", "DueDateType", "StartDate", "NextScheduledDate", "EndDate")
_BATCH = ("BatchPaymentID", "Date", "Type", "Status", "TotalAmount", "UpdatedDateUTC", "IsReconciled")
_PRICE = ("UnitPrice", "AccountCode", "TaxType")


def _prefixed(field: str, subs: tuple[str, ...], prefix: str) -> tuple[tuple[str, str], ...]:
    return tuple((f"{field}.{s}", s if s.startswith(prefix) else prefix + s) for s in subs)


# Sub-fields that are lifted out of a document, per table.
PATHS: dict[str, tuple[tuple[str, str], ...]] = {
    **dict.fromkeys(("invoice", "credit_note", "overpayment", "prepayment", "purchase_order", "quote"), _CONTACT),
    "repeating_invoice": (*_CONTACT, *_prefixed("Schedule", _SCHEDULE, "Schedule")),
    "bank_transaction": (
        *_CONTACT, ("BankAccount.AccountID", "BankAccountID"), *_prefixed("BatchPayment", _BATCH, "BatchPayment"),
        ("ExternalLink.ProviderName", "ExternalLinkProviderName"),
    ),
    "bank_transfer": (("FromBankAccount.AccountID", "FromBankAccountID"), ("ToBankAccount.AccountID", "ToBankAccountID")),
    "batch_payment": (("Account.AccountID", "AccountID"),),
    "expense_claim": (("User.UserID", "UserID"),),
    "receipt": (*_CONTACT, ("User.UserID", "UserID")),
    "item": (*_prefixed("PurchaseDetails", _PRICE, "Purchase"), *_prefixed("SalesDetails", _PRICE, "Sales")),
    "payment": (
        ("Invoice.InvoiceID", "InvoiceID"), ("Invoice.InvoiceNumber", "InvoiceNumber"),
        ("CreditNote.CreditNoteID", "CreditNoteID"), ("CreditNote.CreditNoteNumber", "CreditNoteNumber"),
        ("Prepayment.PrepaymentID", "PrepaymentID"), ("Overpayment.OverpaymentID", "OverpaymentID"),
        ("Account.AccountID", "AccountID"), ("Account.Code", "Code"), ("BatchPayment.BatchPaymentID", "BatchPaymentID"),
    ),
}


def _children(name: str, key: str) -> tuple[Child, ...]:
    table = f"accounting_{name}"
    if name in WITH_LINES:
        tracked = name not in WITHOUT_TRACKING
        return (
            Child(
                "LineItems", f"{table}_line_item", ((key, key),), drop=("Item", "TaxBreakdown", "Tracking"),
                inner="Tracking" if tracked else None, inner_table=f"{table}_line_item_tracking" if tracked else None,
                inner_fields=TRACKING,
            ),
        )
    if name == "manual_journal":
        return (
            Child(
                "JournalLines", f"{table}_line", ((key, key),), own_key="LineItemID", inner="Tracking",
                inner_table=f"{table}_line_tracking", inner_fields=TRACKING,
            ),
        )
    if name == "contact":
        return (Child("Addresses", "accounting_contact_address", ((key, key),)),)
    return ()


def _entity(name: str, key: str) -> Entity:
    return Entity(
        SPECS[f"accounting_{name}"], style="scalars", drop=REDUNDANT, paths=PATHS.get(name, ()),
        children=_children(name, key), slash_dates=True,
    )


ENTITIES: dict[str, Entity] = {f"accounting_{n}": _entity(n, k) for n, k in CURSOR_DOCUMENTS.items()}
ENTITIES |= {
    "accounting_journal": Entity(
        SPECS["accounting_journal"], "scalars", slash_dates=True,
        children=(
            Child(
                "JournalLines", "accounting_journal_line", (("JournalID", "JournalID"),), own_key="JournalLineID",
                inner="TrackingCategories", inner_table="accounting_journal_line_tracking", inner_fields=TRACKING,
            ),
        ),
    ),
    "accounting_tax_rate": Entity(
        SPECS["accounting_tax_rate"], "scalars", slash_dates=True,
        children=(Child("TaxComponents", "accounting_tax_rate_component", (("TaxType", "TaxType"),)),),
    ),
    "accounting_tracking_category": Entity(
        SPECS["accounting_tracking_category"], "scalars", slash_dates=True,
        children=(Child("Options", "accounting_tracking_option", (("TrackingCategoryID", "TrackingCategoryID"),)),),
    ),
    "accounting_contact_group": Entity(
        SPECS["accounting_contact_group"], "scalars", drop=("ValidationErrors",), slash_dates=True,
        children=(Child("Contacts", "accounting_contact_group_member", (("ContactGroupID", "ContactGroupID"),)),),
    ),
    "accounting_organisation": Entity(SPECS["accounting_organisation"], "scalars", drop=ORGANISATION_DROPS, slash_dates=True),
    **{
        n: Entity(SPECS[n], "scalars", slash_dates=True)
        for n in ("accounting_asset", "accounting_asset_type", "accounting_branding_theme", "accounting_currency")
    },
}


def shred(table: str, records: DataFrame) -> dict[str, DataFrame]:
    """Tables of one kind of accounting record."""
    out = shred_entity(ENTITIES[table], records, SPECS)
    name = table.removeprefix("accounting_")
    if name in WITH_ALLOCATIONS and "Allocations" in records.columns:
        out["accounting_allocation"] = allocations(records, CURSOR_DOCUMENTS[name], WITH_ALLOCATIONS[name])
    if name == "organisation":
        settings, _ = split_row(records, SETTINGS, "settings")
        out["accounting_settings"] = strip_nulls(settings, ("_singleton",))
    if name == "contact_group" and "accounting_contact_group_member" in out:
        members = out["accounting_contact_group_member"]
        keep = [c for c in ("ContactGroupID", "ContactID", "Name") if c in members.columns]
        out["accounting_contact_group_member"] = strip_nulls(
            members.select(*keep), SPECS["accounting_contact_group_member"].pk
        )
    return out


def allocations(records: DataFrame, key: str, source_type: str) -> DataFrame:
    """Allocations of credits to invoices, keyed by source, invoice and position."""
    element = records.schema["Allocations"].dataType.elementType.fieldNames()
    source = records.select(F.col(key).alias("SourceID"), F.posexplode("Allocations").alias("Index", "a"))

    def text(path: str) -> Column:
        return F.coalesce(F.col(f"a.{path}"), F.lit("")) if path.split(".")[0] in element else F.lit("")

    return source.select(
        "SourceID",
        F.lit(source_type).alias("SourceType"),
        F.col("Index").cast("string").alias("Index"),
        text("AllocationID").alias("AllocationID"),
        *[F.col(f"a.{c}").alias(c) for c in ("Amount", "Date") if c in element],
        (F.coalesce(F.col("a.IsDeleted"), F.lit(False)) if "IsDeleted" in element else F.lit(False)).alias("IsDeleted"),
        text("Invoice.InvoiceID").alias("InvoiceID"),
        text("Invoice.InvoiceNumber").alias("InvoiceNumber"),
        text("CreditNote.CreditNoteID").alias("CreditNoteID"),
    )


# ---- reports ---------------------------------------------------------------------------------

# The reports that are kept cell by cell.
GENERIC_REPORTS = ("BalanceSheet", "ProfitAndLoss", "BankSummary", "ExecutiveSummary", "BudgetSummary")


def report_tables(reports: DataFrame) -> dict[str, DataFrame]:
    """Landed reports (``ReportType, ReportDate, ReportName, ReportTitle, Rows`` VARIANT) to their tables."""
    keys = ["ReportType", "ReportDate"]
    rows = flatten_report(reports, keys)
    names = {"row_index": "RowIndex", "section": "Section", "row_type": "RowType"}
    balance = trial_balance(rows.filter("ReportType = 'TrialBalance'"), keys).drop("ReportType")
    cells = report_cells(rows.filter("ReportType <> 'TrialBalance'"), keys)
    return {
        "accounting_report_run": report_runs(reports, [c for c in reports.columns if c != "Rows"]),
        "accounting_report_trial_balance": balance.withColumnsRenamed(
            {
                **names, "account_id": "AccountID", "account_name": "AccountName", "debit": "Debit", "credit": "Credit",
                "ytd_debit": "YTDDebit", "ytd_credit": "YTDCredit",
            }
        ),
        "accounting_report_row": cells.withColumnsRenamed(
            {**names, "cell_index": "CellIndex", "cell_value": "CellValue", "cell_account_id": "CellAccountID"}
        ),
    }


# ---- files and projects ----------------------------------------------------------------------

# Output columns and where they come from.
FILE_COLUMNS = {
    "files_file": {
        "FileId": ("Id", "FileId"), "FolderId": ("FolderId",), "Name": ("Name",), "MimeType": ("MimeType",),
        "Size": ("Size",), "User": ("User.Name",), "CreatedDateUtc": ("CreatedDateUtc",), "UpdatedDateUtc": ("UpdatedDateUtc",),
    },
    "files_folder": {
        "FolderId": ("Id", "FolderId"), "Name": ("Name",), "FileCount": ("FileCount",), "Email": ("Email",), "IsInbox": ("IsInbox",),
    },
    "files_association": {
        "FileId": ("FileId",), "ObjectId": ("ObjectId",), "ObjectType": ("ObjectType",), "ObjectGroup": ("ObjectGroup",),
    },
}
MONEY = ("EstimateAmount", "TotalInvoiced", "TotalToBeInvoiced", "TaskAmount", "ExpenseAmount", "Rate", "TotalAmount")
PROJECT_COLUMNS = {
    "projects_project": """ProjectId ContactId Name Status DeadlineUtc EstimateAmount TotalInvoiced TotalToBeInvoiced
        TaskAmount ExpenseAmount MinutesLogged MinutesToBeInvoiced Currency IsTracked""",
    "projects_task": """ProjectId TaskId Name Status Rate ChargeType EstimateMinutes TotalMinutes TotalAmount
        MinutesInvoiced MinutesToBeInvoiced""",
    "projects_time_entry": "TimeEntryId ProjectId TaskId UserId Duration DateUtc Description Status",
    "projects_project_user": "UserId Name Email",
}


def file_rows(table: str, records: DataFrame) -> DataFrame:
    columns = FILE_COLUMNS[table]
    rows = pick_columns(records, list(columns), columns, raw=None)
    return rows.filter(F.coalesce(F.col(SPECS[table].pk[0]), F.lit("")) != "")


def project_rows(table: str, records: DataFrame) -> DataFrame:
    """Fields in small camel case to capital ones; money is the ``value`` of its object."""
    sources = {}
    for name in PROJECT_COLUMNS[table].split():
        small = name[0].lower() + name[1:]
        if name in MONEY:
            sources[name] = ("estimate.value" if name == "EstimateAmount" else f"{small}.value",)
        else:
            sources[name] = ("currencyCode",) if name == "Currency" else (small, name)
    rows = pick_columns(records, list(sources), sources, raw=None)
    return rows.filter(F.coalesce(F.col(SPECS[table].pk[-1]), F.lit("")) != "")
