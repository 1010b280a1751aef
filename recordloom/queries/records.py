"""Records of each domain through the plans that no other query uses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.flatten import split_row
from recordloom.operators.relate import orphan_report
from recordloom.plans import accounting, bookings, erp, forms, hr, payroll, pos, projects
from recordloom.queries.registry import day, query, table


def _text(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# ---- brewery orders -------------------------------------------------------------------------


def _erp_orders(spark, sf) -> DataFrame:
    """Orders with a customer object, payments with what was paid for, and a copy of their lines."""
    refund = F.struct(
        F.concat(F.lit("r"), _text("o_orderkey")).alias("id"), F.col("o_orderstatus").alias("method"),
        F.struct((F.col("o_orderkey") % 50).alias("id"), F.lit("hops").alias("name")).alias("stock_item"),
    )
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_modified_at"),
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name")).alias("customer"),
        F.array(F.struct(F.lit(1).alias("id"))).alias("order_lines"),
        F.when(F.col("o_orderstatus") != "P", F.array(refund)).alias("payments_refunds"),
    )


@query(
    "erp_orders",
    """
    SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS last_modified_at, o_custkey AS customer_id, o_orderpriority AS customer_name FROM orders
    """,
)
def erp_orders(spark, sf):
    return erp.shred("orders", _erp_orders(spark, sf))["orders"]


@query(
    "erp_payments",
    """
    SELECT o_orderkey AS order_id, 'r' || o_orderkey AS id, o_orderstatus AS method, o_orderkey % 50 AS stock_item_id, 'hops' AS stock_item_name
    FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def erp_payments(spark, sf):
    return erp.shred("orders", _erp_orders(spark, sf))["order_payments_refunds"]


@query(
    "erp_unresolved",
    """
    SELECT 'orders' AS "table", 'customer_id' AS "column", 'customers_suppliers' AS target, COUNT(DISTINCT o_custkey) AS unresolved
      FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal < 0
    UNION ALL SELECT 'order_payments_refunds', 'stock_item_id', 'stock_items', COUNT(DISTINCT o_orderkey % 50) FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 50 >= 25
    """,
)
def erp_unresolved(spark, sf):
    """References of the tables are found by their column names and held against incomplete lists."""
    tables = erp.shred("orders", _erp_orders(spark, sf))
    refs = erp.find_references(tables)
    lists = {
        "customers_suppliers": table(spark, sf, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("id")),
        "stock_items": spark.range(25),
    }
    return orphan_report({**tables, **lists}, refs, dict.fromkeys(lists, "id"))


# ---- forms ----------------------------------------------------------------------------------


def _form_records(spark, sf) -> DataFrame:
    lines = F.array(
        F.struct(F.col("p_brand").alias("Item Name"), _text("p_size").alias("Qty")), F.struct(F.lit("").alias("Item Name"), F.lit("0").alias("Qty"))
    )
    return table(spark, sf, "part").select(
        _text("p_partkey").alias("ID"), F.col("p_name").alias("Part.Name"),
        F.struct(F.col("p_type").alias("ID"), F.col("p_brand").alias("display_value")).alias("Client"), lines.alias("Lines"),
    )


@query(
    "forms_records",
    """SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS part_name, p_type AS client_id, p_brand AS client_display_value FROM part""",
)
def forms_records(spark, sf):
    return forms.shred("data_a__b__parts", _form_records(spark, sf))["data_a__b__parts"]


@query(
    "forms_subforms",
    """
    SELECT p_partkey || '__0' AS id, CAST(p_partkey AS VARCHAR) AS parent_id, p_brand AS item_name, CAST(p_size AS VARCHAR) AS qty FROM part
    UNION ALL SELECT p_partkey || '__1', CAST(p_partkey AS VARCHAR), NULL, '0' FROM part
    """,
)
def forms_subforms(spark, sf):
    return forms.shred("data_a__b__parts", _form_records(spark, sf))["data_a__b__parts__sub_lines"]


# ---- HR -------------------------------------------------------------------------------------


@query(
    "hr_form_records",
    """SELECT CAST(c_custkey AS VARCHAR) AS record_id, c_name AS first_name, c_mktsegment AS department_id, 'Dept' AS department_display_value FROM customer""",
)
def hr_form_records(spark, sf):
    """People as records of a form whose fields carry labels."""
    return _hr_form(spark, sf)["form_p_employee"].select("record_id", "first_name", "department_id", "department_display_value")


@query(
    "hr_form_sections",
    """
    SELECT c_custkey || '__0' AS record_id, CAST(c_custkey AS VARCHAR) AS parent_record_id, CAST(c_nationkey AS VARCHAR) AS school FROM customer WHERE c_acctbal >= 0
    """,
)
def hr_form_sections(spark, sf):
    return _hr_form(spark, sf)["form_p_employee__sub_education"].select("record_id", "parent_record_id", "school")


def _hr_form(spark, sf):
    section = F.array(F.struct(_text("c_nationkey").alias("School")))
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("recordId"), F.col("c_name").alias("First Name"),
        F.struct(F.col("c_mktsegment").alias("id"), F.lit("Dept").alias("displayValue")).alias("Department"),
        F.when(F.col("c_acctbal") >= 0, section).alias("Education"),
    )
    return hr.shred_form("form_p_employee", people)


@query(
    "hr_rejects",
    """
    SELECT 'jobs' AS "table", 'missing key: job_id' AS reason, COUNT(*) AS rows FROM part WHERE p_size > 25
    """,
)
def hr_rejects(spark, sf):
    """Jobs that lack their id are counted with their reason."""
    jobs = table(spark, sf, "part").select(F.when(F.col("p_size") <= 25, _text("p_partkey")).alias("jobId"), F.col("p_name").alias("jobName"))
    rejects: list[DataFrame] = []
    hr.rows("jobs", jobs, rejects)
    return reduce(DataFrame.union, rejects).groupBy("table", "reason").agg(F.count("*").alias("rows"))


@query(
    "hr_attendance",
    """
    SELECT CAST(user_id AS VARCHAR) AS employee_id, strftime(ts, '%Y-%m-%d') AS date, CAST(COUNT(*) AS VARCHAR) AS total_hours, 'e' || user_id AS employee_first_name
    FROM events GROUP BY ALL
    """,
)
def hr_attendance(spark, sf):
    """Days of a user under their date, one sheet per month."""
    daily = table(spark, sf, "events").groupBy("user_id", day("ts").alias("date")).agg(_text(F.count("*")).alias("n"))
    entry = F.struct(F.col("date").alias("key"), F.struct(F.col("n").alias("totalHrs")).alias("value"))
    sheets = daily.groupBy("user_id", F.substring("date", 1, 7).alias("month")).agg(F.map_from_entries(F.collect_list(entry)).alias("attendanceDetails"))
    who = F.struct(F.lit("").alias("EmployeeID"), _text("user_id").alias("erecno"), F.concat(F.lit("e"), _text("user_id")).alias("FirstName"))
    records = sheets.select(who.alias("employeeDetails"), "attendanceDetails")
    return hr.attendance_daily(records).select("employee_id", "date", "total_hours", "employee_first_name")


@query(
    "hr_punches",
    """
    SELECT o_custkey AS employee_id, strftime(o_orderdate, '%Y-%m-%d') || '-' || o_orderkey AS date, t.i AS punch_idx,
           CASE t.i WHEN 0 THEN o_orderpriority ELSE o_orderstatus END AS check_in, CASE t.i WHEN 0 THEN 'gate' END AS check_in_location
    FROM orders, (VALUES (0), (1)) AS t(i)
    """,
)
def hr_punches(spark, sf):
    first = F.struct(F.col("o_orderpriority").alias("checkIn"), F.lit("gate").alias("checkIn_Location"))
    second = F.struct(F.col("o_orderstatus").alias("checkIn"), F.lit(None).cast("string").alias("checkIn_Location"))
    records = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("employee_id"), F.concat_ws("-", day("o_orderdate"), "o_orderkey").alias("date"), F.array(first, second).alias("entries")
    )
    return hr.punches(records).select("employee_id", "date", "punch_idx", "check_in", "check_in_location")


@query(
    "hr_latest_entries",
    """
    SELECT o_orderkey AS employee_id, strftime(o_orderdate, '%Y-%m-%d') AS date, 'attEntries' AS source, 'attEntries_0' AS entry_idx, o_orderstatus AS "checkIn" FROM orders
    UNION ALL SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d'), 'multiRegEntries', 'multiRegEntries_' || t.i, o_orderpriority || t.i
      FROM orders, (VALUES (0), (1)) AS t(i) WHERE o_orderstatus = 'F'
    """,
)
def hr_latest_entries(spark, sf):
    regular = F.array(F.struct(F.col("o_orderstatus").alias("checkIn")))
    several = F.array(*[F.struct(F.concat("o_orderpriority", F.lit(str(i))).alias("checkIn")) for i in range(2)])
    lists = F.struct(regular.alias("attEntries"), F.when(F.col("o_orderstatus") == "F", several).alias("multiRegEntries"))
    records = table(spark, sf, "orders").select(F.col("o_orderkey").alias("employee_id"), F.create_map(day("o_orderdate"), lists).alias("entries"))
    return hr.latest_entries(records).select("employee_id", "date", "source", "entry_idx", "checkIn")


@query(
    "hr_shifts",
    """SELECT o_orderkey AS employee_id, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderstatus AS shift_name FROM orders""",
)
def hr_shifts(spark, sf):
    """Vendor dates such as 29-Nov-2025; entries without a date are refused."""
    dated = F.struct(F.date_format("o_orderdate", "dd-MMM-yyyy").alias("date"), F.col("o_orderstatus").alias("shiftName"))
    undated = F.struct(F.lit(None).cast("string").alias("date"), F.lit("lost").alias("shiftName"))
    records = table(spark, sf, "orders").select(F.col("o_orderkey").alias("employee_id"), F.array(dated, undated).alias("shiftList"))
    return hr.shift_mappings(records).select("employee_id", "date", "shift_name")


def _balance_reports(spark, sf) -> DataFrame:
    """Reports by hour: all types of a user in one map, all users of an hour in another; every seventh user is not listed."""
    facts = (
        table(spark, sf, "events")
        .groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("hour"), "user_id", "event_type")
        .agg(F.count("*").alias("booked"))
    )
    vals = F.struct(
        "booked", (F.lit(30) - F.col("booked")).alias("balance"), (F.lit(20) - F.col("booked")).alias("available"),
        F.when(F.col("event_type") == "click", "Hour").alias("unit"),
    )
    users = facts.groupBy("hour", "user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", vals))).alias("types"), F.collect_set("event_type").alias("met")
    )
    meta = F.transform(F.flatten(F.collect_list("met")), lambda t: F.struct(t, F.struct(F.upper(t).alias("name"), F.lit("Day").alias("unit"), F.lit("PAID").alias("type"))))
    who = _text("user_id")
    return users.groupBy("hour").agg(
        F.map_from_entries(F.collect_list(F.struct(who, "types"))).alias("report"),
        F.collect_list(F.when(F.col("user_id") % 7 != 0, who)).alias("employees"),
        F.map_from_entries(F.array_distinct(meta)).alias("leavetypes"),
    )


@query(
    "hr_leave_balance",
    """
    SELECT strftime(ts, '%Y-%m-%d %H') AS hour, CAST(user_id AS VARCHAR) AS employee_id, event_type AS leave_type_id, '2024-01-01' AS from_date, '2024-12-31' AS to_date,
           COUNT(*) AS booked, 30 - COUNT(*) AS balance, 20 - COUNT(*) AS available, CASE WHEN event_type = 'click' THEN 'Hour' ELSE 'Day' END AS unit,
           COUNT(*) AS raw_booked
    FROM events WHERE user_id % 7 <> 0 GROUP BY ALL
    """,
)
def hr_leave_balance(spark, sf):
    """Balances of listed users with their unit and the figures as they came."""
    reports = _balance_reports(spark, sf)
    # the hour stands in for the report's page: the plan's rows do not carry it, so it goes with the employee
    tagged = reports.withColumns(
        {
            "report": F.transform_keys("report", lambda k, v: F.concat_ws("@", k, "hour")),
            "employees": F.transform("employees", lambda e: F.concat_ws("@", e, "hour")),
        }
    )
    rows = hr.balance_tables(tagged, "2024-01-01", "2024-12-31")["leave_balance"]
    parts = F.split("employee_id", "@")
    return rows.select(
        parts[1].alias("hour"), parts[0].alias("employee_id"), "leave_type_id", "from_date", "to_date", "booked", "balance", "available", "unit",
        F.get_json_object("raw_vals", "$.booked").cast("bigint").alias("raw_booked"),
    )


@query(
    "hr_leave_types",
    "SELECT DISTINCT event_type AS id, upper(event_type) AS name, 'Day' AS unit, 'PAID' AS type FROM events WHERE event_type <> 'view'",
)
def hr_leave_types(spark, sf):
    """Types that the balance reports name, without one that is known already."""
    known = table(spark, sf, "region").limit(1).select(F.lit("view").alias("id"))
    return hr.balance_tables(_balance_reports(spark, sf), "2024-01-01", "2024-12-31", known)["leave_types"]


# ---- projects -------------------------------------------------------------------------------


def _tasks(spark, sf) -> DataFrame:
    owner = F.struct(_text("p_size").alias("zpuid"), F.col("p_brand").alias("name"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.struct(F.col("p_size").alias("id"), F.col("p_type").alias("name")).alias("owner"),
        F.array(F.struct(F.col("p_brand").alias("id"), F.col("p_type").alias("name"))).alias("tags"),
        F.struct(F.array(owner).alias("owners")).alias("details"), F.col("p_brand").alias("UDF_CHAR1"),
    )


def _keyed_tasks(spark, sf) -> DataFrame:
    return _tasks(spark, sf).withColumns({"portal_id": F.lit("p"), "project_id": F.lit("j"), "task_id": _text("id")})


@query(
    "project_tasks",
    """
    SELECT 'p' AS portal_id, 'j' AS project_id, CAST(p_partkey AS VARCHAR) AS task_id, p_name AS name, p_type AS owner_name, CAST(p_size AS VARCHAR) AS owner_id FROM part
    """,
)
def project_tasks(spark, sf):
    rows = projects.rows("tasks", _tasks(spark, sf), portal_id="p", project_id="j")
    return rows.select("portal_id", "project_id", "task_id", "name", "owner_name", _text("owner_id").alias("owner_id"))


@query(
    "project_task_owners",
    "SELECT CAST(p_partkey AS VARCHAR) AS task_id, CAST(p_size AS VARCHAR) AS user_id, p_brand AS name FROM part",
)
def project_task_owners(spark, sf):
    people = projects.people("task_owners", _keyed_tasks(spark, sf), projects.OWNER_PLACES, ["portal_id", "project_id", "task_id"])
    return people.select("task_id", "user_id", "name")


@query(
    "project_task_tags",
    "SELECT 'task' AS entity_type, CAST(p_partkey AS VARCHAR) AS entity_id, p_brand AS tag_id, p_type AS tag_name FROM part",
)
def project_task_tags(spark, sf):
    return projects.tags("tasks", _keyed_tasks(spark, sf)).select("entity_type", "entity_id", "tag_id", "tag_name")


@query(
    "project_custom_fields",
    "SELECT CAST(p_partkey AS VARCHAR) AS task_id, 'UDF_CHAR1' AS field_api_name, p_brand AS value_text FROM part",
)
def project_custom_fields(spark, sf):
    record = F.parse_json(F.to_json(F.struct("id", "UDF_CHAR1")))
    keyed = _keyed_tasks(spark, sf).select("portal_id", "project_id", "task_id", record.alias("record"))
    return projects.custom_fields("tasks", keyed).select("task_id", "field_api_name", "value_text")


# ---- bookings -------------------------------------------------------------------------------


@query(
    "bookings_staff",
    """
    SELECT 'staff' AS "table", CAST(s_suppkey AS VARCHAR) AS id, s_name AS other FROM supplier
    UNION ALL SELECT 'service', CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR) FROM supplier
    UNION ALL SELECT 'workspace', CAST(s_suppkey AS VARCHAR), 'w' || (s_suppkey % 3) FROM supplier
    """,
)
def bookings_staff(spark, sf):
    """Staff with services, and the workspace under which each record was read."""
    staff = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.array(_text("s_nationkey"), F.lit(None).cast("string")).alias("assigned_services"),
        F.concat(F.lit("w"), _text(F.col("s_suppkey") % 3)).alias("workspace_id"),
    )
    out = bookings.shred_staff(staff)
    parts = [
        out["staff"].select(F.lit("staff").alias("table"), _text("id").alias("id"), F.col("name").alias("other")),
        out["staff_service_assignments"].select(F.lit("service"), _text("staff_id"), "service_id"),
        out["staff_workspace_assignments"].select(F.lit("workspace"), _text("staff_id"), "workspace_id"),
    ]
    return reduce(DataFrame.union, parts)


@query(
    "bookings_appointments",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS booking_id, o_orderpriority AS customer_more_info_note FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderkey % 10 <> 0
    """,
)
def bookings_appointments(spark, sf):
    """Appointments of two workspaces and of none; rows without a booking are refused."""
    records = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 10 != 0, _text("o_orderkey")).alias("booking_id"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("workspace_id"),
        F.struct(F.col("o_orderpriority").alias("note")).alias("customer_more_info"),
    )
    return bookings.shred_appointments(records, ["P"])["appointments"].select("booking_id", "customer_more_info_note")


@query(
    "bookings_workspaces",
    "SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey IN (1, 3, 5)",
)
def bookings_workspaces(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return bookings.shred_plain("workspaces", nations, ["1", "3", "5"])["workspaces"].select("id", "name")


# ---- accounting -----------------------------------------------------------------------------


@query(
    "accounting_allocations",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS "SourceID", 'CreditNote' AS "SourceType", CAST(t.i AS VARCHAR) AS "Index",
           CASE t.i WHEN 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS "InvoiceID", o_totalprice AS "Amount"
    FROM orders, (VALUES (0), (1)) AS t(i)
    """,
)
def accounting_allocations(spark, sf):
    """Credits allocated to an invoice and to none."""
    invoice = F.struct(_text("o_custkey").alias("InvoiceID"), F.lit("7").alias("InvoiceNumber"))
    some = F.struct(F.col("o_totalprice").alias("Amount"), invoice.alias("Invoice"))
    none = F.struct(F.col("o_totalprice").alias("Amount"), F.lit(None).cast("struct<InvoiceID:string,InvoiceNumber:string>").alias("Invoice"))
    notes = table(spark, sf, "orders").select(_text("o_orderkey").alias("CreditNoteID"), F.array(some, none).alias("Allocations"))
    return accounting.shred("accounting_credit_note", notes)["accounting_allocation"].select("SourceID", "SourceType", "Index", "InvoiceID", "Amount")


@query(
    "accounting_reports",
    """
    SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'TrialBalance' ELSE 'BankSummary' END AS "table", CAST(o_orderkey AS VARCHAR) AS "ReportDate",
           CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS "Debit", CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_totalprice AS VARCHAR) END AS "CellValue"
    FROM orders
    """,
)
def accounting_reports(spark, sf):
    """Trial balances become typed rows, other reports one row per cell."""
    cells = F.array(F.struct(F.lit("A").alias("Value")), F.struct(_text("o_totalprice").alias("Value")))
    rows = F.array(F.struct(F.lit("Row").alias("RowType"), cells.alias("Cells")))
    reports = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 2 == 0, "TrialBalance").otherwise("BankSummary").alias("ReportType"), _text("o_orderkey").alias("ReportDate"),
        F.lit("n").alias("ReportName"), F.lit("t").alias("ReportTitle"), F.parse_json(F.to_json(rows)).alias("Rows"),
    )
    out = accounting.report_tables(reports)
    balance = out["accounting_report_trial_balance"].select(F.lit("TrialBalance").alias("table"), "ReportDate", "Debit", F.lit(None).cast("string").alias("CellValue"))
    other = out["accounting_report_row"].filter("CellIndex = 1").select(F.lit("BankSummary"), "ReportDate", F.lit(None).cast("double"), "CellValue")
    return balance.union(other)


@query(
    "accounting_files",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS owner, NULL::DOUBLE AS amount FROM part WHERE p_size > 10
    UNION ALL SELECT 'p' || p_partkey, p_name, 'GBP', p_retailprice FROM part
    """,
)
def accounting_files(spark, sf):
    """Files without an id are left out; project money is the value of its object."""
    parts = table(spark, sf, "part")
    files = parts.select(
        F.when(F.col("p_size") > 10, _text("p_partkey")).alias("Id"), F.col("p_name").alias("Name"), F.struct(F.col("p_brand").alias("Name")).alias("User")
    )
    plans = parts.select(
        F.concat(F.lit("p"), _text("p_partkey")).alias("projectId"), F.col("p_name").alias("name"),
        F.struct(F.col("p_retailprice").alias("value")).alias("estimate"), F.lit("GBP").alias("currencyCode"),
    )
    listed = accounting.file_rows("files_file", files).select(F.col("FileId").alias("id"), F.col("Name").alias("name"), F.col("User").alias("owner"), F.lit(None).cast("double").alias("amount"))
    return listed.union(accounting.project_rows("projects_project", plans).select("ProjectId", "Name", "Currency", "EstimateAmount"))


@query(
    "organisation_settings",
    """
    SELECT c_custkey AS "OrganisationID", c_mktsegment AS "BaseCurrency", 'settings' AS "key", c_name AS name FROM customer
    """,
)
def organisation_settings(spark, sf):
    """Both outputs of a split record, joined by what they share: settings with their fixed key, and the whole row."""
    records = table(spark, sf, "customer").select(F.col("c_custkey").alias("OrganisationID"), F.col("c_mktsegment").alias("BaseCurrency"), "c_name")
    settings, whole = split_row(records, ["OrganisationID", "BaseCurrency"], "settings")
    return settings.select("OrganisationID", "BaseCurrency", F.col("_singleton").alias("key")).join(whole.select("OrganisationID", F.col("c_name").alias("name")), "OrganisationID")


# ---- payroll and point of sale --------------------------------------------------------------


@query(
    "payslip_tables",
    """
    SELECT t.name AS "table", CAST(c_custkey AS VARCHAR) AS "paySlipID", CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment ELSE '0' END AS id, c_acctbal AS amount
    FROM customer, (VALUES ('earning'), ('deduction'), ('leave_accrual'), ('reimbursement'), ('benefit'), ('tax'), ('court_order'), ('payment')) AS t(name)
    """,
)
def payslip_tables(spark, sf):
    """All eight kinds of payslip lines; a line without an id is keyed by its position."""

    def line(array):
        own = array.removesuffix("Lines") + "LineID"
        return F.array(F.struct(F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).alias(own), F.col("c_acctbal").alias("amount")))

    slips = table(spark, sf, "customer").select(_text("c_custkey").alias("paySlipID"), *[line(a).alias(a) for a in payroll.PAYSLIP_LINES])
    out = payroll.shred("payroll_payslip", slips)
    parts = [
        out[name].select(
            F.lit(name.removeprefix("payroll_payslip_").removesuffix("_line")).alias("table"), "paySlipID",
            F.col(array.removesuffix("Lines") + "LineID").alias("id"), "amount",
        )
        for array, name in payroll.PAYSLIP_LINES.items()
    ]
    return reduce(DataFrame.union, parts)


@query(
    "pos_time_entries",
    """
    SELECT 'entry' AS "table", CAST(event_id AS VARCHAR) AS id, event_type AS other FROM events
    UNION ALL SELECT 'break', 'b' || event_id, CAST(event_id AS VARCHAR) FROM events
    """,
)
def pos_time_entries(spark, sf):
    """Time entries with their job, and their breaks."""
    records = table(spark, sf, "events").select(
        _text("event_id").alias("guid"), _text("user_id").alias("restaurant_id"), F.struct(F.col("event_type").alias("guid")).alias("jobReference"),
        F.array(F.struct(F.concat(F.lit("b"), _text("event_id")).alias("guid"), F.struct(F.lit("t").alias("guid")).alias("breakType"))).alias("breaks"),
    )
    out = pos.shred_config("time_entry", records)
    entries = out["time_entry"].select(F.lit("entry").alias("table"), "id", F.col("job_reference_id").alias("other"))
    return entries.union(out["break"].select(F.lit("break"), "id", "time_entry_id"))


@query(
    "pos_details",
    """SELECT CAST(n_nationkey AS VARCHAR) AS restaurant_id, n_name AS general_name, '{"region":' || n_regionkey || '}' AS hours FROM nation""",
)
def pos_details(spark, sf):
    """One object per restaurant: promoted sections as columns, the rest as JSON."""
    records = table(spark, sf, "nation").select(
        _text("n_nationkey").alias("restaurant_id"), F.struct(F.col("n_name").alias("name")).alias("general"), F.struct(F.col("n_regionkey").alias("region")).alias("hours")
    )
    return pos.shred_detail("restaurant_detail", records)["restaurant_detail"].select("restaurant_id", "general_name", "hours")


