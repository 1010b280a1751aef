"""Record kinds of every domain to their tables."""

import json
import time

from pyspark.sql import functions as F

from recordloom.plans import accounting, bookings, erp, forms, hr, payroll, pos, projects, psa


def test_every_table_is_keyed():
    for domain in (accounting, bookings, erp, forms, hr, payroll, pos, projects, psa):
        for name, spec in domain.SPECS.items():
            assert spec.name == name and spec.pk and len(set(spec.pk)) == len(spec.pk)
    assert len(accounting.SPECS) + len(payroll.SPECS) == 95


def test_delete_routing_knows_both_forms():
    for form, table in {
        "task": "tasks", "person": "people", "company": "companies", "deal_status": "deal_statuses", "time_entry": "time_entries",
        "salary": "salaries", "price": "prices", "purchase_order": "purchase_orders", "page": "pages", "expenses": "expenses",
    }.items():
        assert psa.DELETE_ROUTING[form] == table
    assert "unknown" not in psa.DELETE_ROUTING


def test_psa(records, rows_of):
    df = records('{"id":"1","type":"tasks","attributes":{"title":"T","closed":null},"relationships":{"project":{"data":{"id":"5","type":"p"}}}}')
    out = psa.shred("tasks", df)["tasks"]
    row = out.first()
    assert row["id"] == "1" and row["project_id"] == "5" and sorted(row["present"]) == ["project_id", "title"]


INVOICE = {
    "InvoiceID": "i1", "Status": "PAID", "UpdatedDateUTC": "/Date(1700000000000+0000)/", "Total": "12.50", "DateString": "x",
    "Contact": {"ContactID": "c1", "Name": "N"}, "Payments": [{"PaymentID": "p"}],
    "LineItems": [
        {"LineItemID": "l1", "Quantity": 2, "Item": {"ItemID": "q"}, "Tracking": [{"TrackingCategoryID": "t", "TrackingOptionID": "o", "Name": "n", "Option": "p"}]},
        {"LineItemID": "l2", "Quantity": 1, "Tracking": []},
    ],
}


def test_accounting_document(records, rows_of):
    out = accounting.shred("accounting_invoice", records(json.dumps(INVOICE)))
    head = out["accounting_invoice"].first().asDict()
    assert head["Total"] == 12.5 and head["ContactID"] == "c1" and head["UpdatedDateUTC"] == "2023-11-14T22:13:20Z"
    assert not {"LineItems", "Payments", "DateString", "Contact"} & set(head)
    lines = out["accounting_invoice_line_item"]
    assert rows_of(lines, "InvoiceID", "LineItemID", "Quantity") == [("i1", "l1", 2.0), ("i1", "l2", 1.0)]
    assert not {"Item", "Tracking"} & set(lines.columns)
    tracking = out["accounting_invoice_line_item_tracking"]
    assert rows_of(tracking, "InvoiceID", "LineItemID", "TrackingCategoryID", "Option") == [("i1", "l1", "t", "p")]
    assert accounting.SPECS["accounting_invoice"].status_column == "Status"


def test_accounting_journal_lines_without_id(records, rows_of):
    df = records(
        '{"JournalID":"j","JournalNumber":3,"JournalLines":[{"NetAmount":1.5,"TrackingCategories":[{"TrackingCategoryID":"t"}]},{"NetAmount":2}]}'
    )
    out = accounting.shred("accounting_journal", df)
    assert rows_of(out["accounting_journal_line"], "JournalID", "JournalLineID", "NetAmount") == [("j", "0", 1.5), ("j", "1", 2.0)]
    assert rows_of(out["accounting_journal_line_tracking"], "JournalID", "JournalLineID", "TrackingCategoryID") == [("j", "0", "t")]


def test_accounting_allocations_and_settings(records, rows_of):
    df = records('{"CreditNoteID":"n","Allocations":[{"Amount":5,"Invoice":{"InvoiceID":"i","InvoiceNumber":"7"}},{"Amount":6,"Invoice":null}]}')
    out = accounting.shred("accounting_credit_note", df)
    got = rows_of(out["accounting_allocation"], "SourceID", "SourceType", "InvoiceID", "Index", "Amount")
    assert got == [("n", "CreditNote", "", "1", 6), ("n", "CreditNote", "i", "0", 5)]
    org = accounting.shred("accounting_organisation", records('{"OrganisationID":"o","Name":"X","BaseCurrency":"GBP","Phones":[{"a":1}]}'))
    assert org["accounting_settings"].first()["BaseCurrency"] == "GBP" and "Phones" not in org["accounting_organisation"].columns
    assert org["accounting_settings"].first()["_singleton"] == "settings"


def test_payment_lifts_its_references(records):
    df = records('{"PaymentID":"p","Amount":1,"Status":"DELETED","Invoice":{"InvoiceID":"i","InvoiceNumber":"3"},"Account":{"AccountID":"a","Code":"090"}}')
    row = accounting.shred("accounting_payment", df)["accounting_payment"].first().asDict()
    assert row["InvoiceID"] == "i" and row["Code"] == "090" and "Invoice" not in row


def test_accounting_files_and_projects(records):
    row = accounting.file_rows("files_file", records('{"Id":"f","Name":"n","User":{"Name":"u"}}', '{"Name":"no id"}')).collect()
    assert len(row) == 1 and row[0]["FileId"] == "f" and row[0]["User"] == "u"
    row = accounting.project_rows("projects_project", records('{"projectId":"p","name":"n","estimate":{"value":5.5},"currencyCode":"GBP"}')).first()
    assert row["ProjectId"] == "p" and row["EstimateAmount"] == 5.5 and row["Currency"] == "GBP" and row["TotalInvoiced"] is None


def test_accounting_reports(spark):
    rows = json.dumps([{"RowType": "Row", "Cells": [{"Value": "A"}, {"Value": "1"}]}])
    df = spark.createDataFrame([("TrialBalance", "d", "n", "t", rows), ("BankSummary", "d", "n", "t", rows)], "ReportType string, ReportDate string, ReportName string, ReportTitle string, j string")
    out = accounting.report_tables(df.withColumn("Rows", F.parse_json("j")).drop("j"))
    assert out["accounting_report_run"].count() == 2
    assert out["accounting_report_trial_balance"].first()["Debit"] == 1.0
    assert {r["CellValue"] for r in out["accounting_report_row"].collect()} == {"A", "1"}


def test_payroll(records, rows_of):
    df = records('{"paySlipID":"s","totalPay":"10.5","earningsLines":[{"amount":1},{"earningsLineID":"e","amount":2}],"taxLines":[{"taxLineID":"t","amount":3}]}')
    out = payroll.shred("payroll_payslip", df)
    assert out["payroll_payslip"].first()["totalPay"] == 10.5
    assert rows_of(out["payroll_payslip_earning_line"], "paySlipID", "earningsLineID", "amount") == [("s", "0", 1.0), ("s", "e", 2.0)]
    assert rows_of(out["payroll_payslip_tax_line"], "taxLineID") == [("t",)]
    out = payroll.shred("payroll_employee", records('{"employeeID":"e","address":{"city":"X"}}'))
    assert out["payroll_employee"].first()["address"] == '{"city":"X"}'
    out = payroll.shred("payroll_employment", records('{"startDate":"d"}'), employeeID="e")
    assert out["payroll_employment"].first()["employeeID"] == "e"
    out = payroll.shred("payroll_settings", records('{"accounts":[{"a":1}]}'))
    assert out["payroll_settings"].first()["_singleton"] == "settings"


def test_erp(records, rows_of):
    df = records(
        '{"id":1,"customer":{"id":7,"name":"A"},"order_lines":[{"id":1}],"payments_refunds":[{"id":5,"stock_item":{"id":9,"name":"m"}}]}'
    )
    out = erp.shred("orders", df)
    assert set(out["orders"].columns) == {"id", "customer_id", "customer_name"}
    assert rows_of(out["order_payments_refunds"], "order_id", "id", "stock_item_id") == [(1, 5, 9)]
    refs = {(r.table, r.column, r.target) for r in erp.find_references(out)}
    assert refs == {("orders", "customer_id", "customers_suppliers"), ("order_payments_refunds", "stock_item_id", "stock_items")}


def test_forms(records, rows_of):
    out = forms.shred("data_a__b__c", records('{"ID":"1","Lines":[{"Qty":"2"}],"Client":{"ID":"9","display_value":"X"}}'))
    assert rows_of(out["data_a__b__c"], "id", "client_id", "client_display_value") == [("1", "9", "X")]
    assert rows_of(out["data_a__b__c__sub_lines"], "id", "parent_id", "qty") == [("1__0", "1", "2")]


def test_bookings(records, rows_of):
    df = records(
        '{"id":"s1","name":"Cut","assigned_staffs":["a","b",null],"assigned_workspace":"w1","workspace_id":"q"}',
        '{"id":"s2","name":"Wash","assigned_staffs":[],"workspace_id":"q"}',
        '{"name":"no id","workspace_id":"q"}',
    )
    out = bookings.shred_services(df)
    assert rows_of(out["services"], "id", "name") == [("s1", "Cut"), ("s2", "Wash")]
    assert rows_of(out["service_staff_assignments"]) == [("s1", "a"), ("s1", "b")]
    assert rows_of(out["service_workspace_assignments"]) == [("s1", "w1"), ("s2", "q")]
    staff = bookings.shred_staff(records('{"id":1,"assigned_services":["x"],"workspace_id":"q"}'))
    assert rows_of(staff["staff_workspace_assignments"]) == [("1", "q")]
    appointments = bookings.shred_appointments(
        records(
            '{"booking_id":"b1","workspace_id":"w","customer_more_info":{"dob":"d"}}', '{"booking_id":"b2","workspace_id":"other"}', '{"booking_id":"","workspace_id":"w"}'
        ),
        ["w"],
    )["appointments"]
    assert rows_of(appointments, "booking_id", "customer_more_info_dob") == [("b1", "d")]


def test_hr_form(records, rows_of):
    df = records('{"recordId":"5","First Name":"A","Dept":{"id":"1","displayValue":"D"},"Education":[{"School":"S"},{"recordId":"7","School":"T"}]}', '{"First Name":"none"}')
    out = hr.shred_form("form_p_employee", df)
    assert rows_of(out["form_p_employee"], "record_id", "first_name", "dept_id") == [("5", "A", "1")]
    assert rows_of(out["form_p_employee__sub_education"], "record_id", "parent_record_id", "school") == [("5__0", "5", "S"), ("7", "5", "T")]


def test_hr_leave(records, rows_of):
    body = (
        '{"Zoho.ID":111,"Leavetype.ID":22,"Leavetype":"Annual","Unit":"Days","Type":"PAID","EmployeeId":"Jane Doe ","From":"2026-03-18",'
        '"Days":{"2026-03-18":{"LeaveCount":"1.0","StartTime":"09:00"}}}'
    )
    schema = (
        "`Zoho.ID` bigint, `Leavetype.ID` bigint, Leavetype string, Unit string, Type string, EmployeeId string, `From` string,"
        " Days map<string,struct<LeaveCount:string,StartTime:string,EndTime:string>>"
    )
    out = hr.shred_leave(records(body, schema=schema))
    row = out["leave_records"].first()
    assert row["id"] == "111" or row["id"] == 111
    assert row["employee_id_name"] == "Jane Doe" and row["from_date"] == "2026-03-18" and row["leave_type_name"] == "Annual"
    assert rows_of(out["leave_records_days"], "leave_id", "date", "leave_count", "start_time") == [("111", "2026-03-18", "1.0", "09:00")]
    assert rows_of(out["leave_types"], "name", "unit", "type") == [("Annual", "Days", "PAID")]


def test_hr_attendance(records, rows_of):
    schema = "employeeDetails struct<EmployeeID:string,FirstName:string,erecno:string>, attendanceDetails map<string,struct<WorkingHours:string,totalHrs:string>>"
    df = records('{"employeeDetails":{"EmployeeID":"","erecno":"e9","FirstName":"A"},"attendanceDetails":{"2024-01-01":{"totalHrs":"8"}}}', schema=schema)
    assert rows_of(hr.attendance_daily(df), "employee_id", "date", "total_hours", "employee_first_name") == [("e9", "2024-01-01", "8", "A")]
    df = records('{"employee_id":"e","date":"d","entries":[{"checkIn":"9","checkIn_Location":"L"},{"checkIn":"13"}]}')
    assert rows_of(hr.punches(df), "punch_idx", "check_in", "check_in_location") == [(0, "9", "L"), (1, "13", None)]
    schema = "employee_id string, entries map<string,struct<attEntries:array<struct<checkIn:string>>,multiRegEntries:array<struct<checkIn:string>>>>"
    df = records('{"employee_id":"e","entries":{"d":{"attEntries":[{"checkIn":"9"}],"multiRegEntries":[{"checkIn":"10"}]}}}', schema=schema)
    assert rows_of(hr.latest_entries(df), "date", "source", "entry_idx") == [("d", "attEntries", "attEntries_0"), ("d", "multiRegEntries", "multiRegEntries_0")]
    df = records('{"employee_id":"e","shiftList":[{"date":"29-Nov-2025","shiftName":"Day"},{"shiftName":"no date"}]}')
    assert rows_of(hr.shift_mappings(df), "employee_id", "date", "shift_name") == [("e", "2025-11-29", "Day")]


def test_hr_rows_by_rule(records, rows_of):
    df = records('{"JobId":5,"jobName":"","JobName":"N","hours":3,"owner":{"id":1}}', '{"jobName":"no id"}')
    row = hr.rows("jobs", df).first()
    assert row["job_id"] in (5, "5") and row["job_name"] == "N" and row["estimated_hours"] in (3, "3") and row["owner"] == '{"id":1}'
    assert row["from_date"] is None and json.loads(row["raw_record"])["JobId"] == 5
    for table in hr.COLUMNS:
        assert set(hr.SPECS[table].pk) <= set(hr.COLUMNS[table].split())


def test_leave_balance(records, rows_of):
    df = records('{"report":{"e1":{"t":{"booked":1.0,"balance":2.0}}}}', schema="report map<string,map<string,struct<booked:double,balance:double>>>")
    got = rows_of(hr.leave_balance(df, "2024-01-01", "2024-12-31"), "employee_id", "leave_type_id", "booked", "balance", "from_date", "to_date")
    assert got == [("e1", "t", 1.0, 2.0, "2024-01-01", "2024-12-31")]


def test_leave_balance_of_listed_employees(records, rows_of):
    vals = "struct<booked:double,balance:double,available:double,unit:string>"
    df = records(
        '{"report":{"e1":{"t":{"booked":1,"balance":2,"available":3,"unit":"Hour"},"totals":{"booked":4}},"e2":{"t":{"booked":9}}},"employees":["e1","e9"],'
        '"leavetypes":{"t":{"name":"Annual","unit":"Day"},"u":{"name":"Sick"}}}',
        schema=f"report map<string,map<string,{vals}>>, employees array<string>, leavetypes map<string,struct<name:string,unit:string,type:string>>",
    )
    out = hr.balance_tables(df, "a", "b")
    got = rows_of(out["leave_balance"], "employee_id", "leave_type_id", "available", "unit", "raw_vals")
    assert got == [("e1", "t", 3.0, "Hour", '{"booked":1.0,"balance":2.0,"available":3.0,"unit":"Hour"}'), ("e1", "totals", None, "Day", '{"booked":4.0}')]
    assert rows_of(out["leave_types"]) == [("t", "Annual", "Day", None), ("u", "Sick", None, None)]
    assert rows_of(hr.balance_tables(df, "a", "b", out["leave_types"].filter("id = 't'"))["leave_types"], "id") == [("u",)]


def test_leave_balance_of_one_large_report(spark):
    """30,000 employees of one report took 900 million comparisons."""
    n = 30_000
    ids = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(F.lit("e"), i.cast("string")))
    types = F.create_map(F.lit("t"), F.struct(F.lit(1.0).alias("booked")))
    report = F.map_from_entries(F.transform(ids, lambda e: F.struct(e, types)))
    listed = F.concat(F.transform(ids, lambda e: F.when(F.substring(e, -1, 1) != "7", e)), F.array(F.lit("e1"), F.lit("stranger")))
    reports = spark.range(1).select(report.alias("report"), listed.alias("employees"))
    began = time.monotonic()
    got = hr.leave_balance(reports, "a", "b").agg(F.count("*"), F.countDistinct("employee_id"), F.count_if(F.col("employee_id").endswith("7"))).first()
    assert tuple(got) == (27_000, 27_000, 0)
    assert time.monotonic() - began < 20


def test_leave_balance_of_odd_lists(records, rows_of):
    schema = "report map<string,map<string,struct<booked:double>>>, employees array<bigint>"
    df = records(
        '{"report":{"1":{"t":{"booked":1}},"2":null,"3":{"t":null}},"employees":[1,1,null,2,3]}',
        '{"report":{"4":{"t":{"booked":1}}},"employees":null}', '{"report":{"5":{"t":{"booked":1}}},"employees":[]}', '{"report":null,"employees":[6]}',
        schema=schema,
    )
    assert rows_of(hr.leave_balance(df, "a", "b"), "employee_id", "leave_type_id", "booked") == [("1", "t", 1.0)]


def test_raw_leave_record_keeps_its_names(records):
    df = records('{"Zoho.ID":1,"Leavetype.ID":2}', '{"Leavetype.ID":3}', schema="`Zoho.ID` bigint, `Leavetype.ID` bigint")
    rejects = []
    row = hr.shred_leave(df, rejects)["leave_records"].first()
    assert json.loads(row["raw_record"]) == {"Zoho.ID": 1, "Leavetype.ID": 2}
    assert rejects[0].count() == 1 and rejects[0].first()["reason"] == "missing key: id"


def test_projects(records, rows_of):
    df = records(
        '{"id":5,"name":"T","owner":{"id":1,"name":"O"},"UDF_CHAR1":"x","tags":[{"id":"9","name":"n"}],"created_time_long":1700000000000,'
        '"dependency":{"successor":[{"id":"6"}],"predecessor":[{"id":"4"}]},"details":{"owners":[{"zpuid":"z","name":"Z"}]}}'
    )
    rows = projects.rows("tasks", df, portal_id="p", project_id="j")
    got = rows.first().asDict()
    assert got["task_id"] == "5" and got["owner_name"] == "O" and got["created_time_at"].startswith("2023") and "tags" not in got
    keyed = df.withColumns({"portal_id": F.lit("p"), "project_id": F.lit("j"), "task_id": F.col("id").cast("string")})
    assert rows_of(projects.tags("tasks", keyed), "entity_type", "entity_id", "tag_id", "tag_name") == [("task", "5", "9", "n")]
    carry = ["portal_id", "project_id", "task_id"]
    assert rows_of(projects.people("task_owners", keyed, projects.OWNER_PLACES, carry), "task_id", "user_id", "name") == [("5", "z", "Z")]
    assert rows_of(projects.dependencies(keyed), "task_id", "depends_on_task_id", "direction") == [("5", "4", "predecessor"), ("5", "6", "successor")]


def test_project_time_logs(records, rows_of):
    df = records(
        '{"date":"03-18-2026","tasklogs":[{"task_name":"T","logs":[{"id":"1","hours":"2"}]}],"buglogs":[{"id":"2","hours":"3","task_name":"B","logs":[]}],"generallogs":[]}'
    )
    got = projects.time_logs(df, "p")
    assert rows_of(got, "portal_id", "log_id", "component_type", "task_name", "hours", "log_date") == [
        ("p", "1", "task", "T", "2", "03-18-2026"), ("p", "2", "bug", "B", "3", "03-18-2026"),
    ]


ORDER = {
    "guid": "o", "restaurant_id": "r", "deleted": False, "createdDate": "2024-01-01T10:00:00.000Z", "pricingFeatures": ["A", "A", "B"],
    "diningOption": {"guid": "d", "entityType": "X"}, "server": {"guid": "s"},
    "checks": [{
        "guid": "c", "payments": [{"guid": "p", "amount": 5, "refund": {"refundAmount": 1, "tipRefundAmount": 2}, "voidInfo": {"voidDate": "v", "voidApprover": {"guid": "a"}}}],
        "appliedDiscounts": [{"guid": "ad", "discount": {"guid": "dd"}, "triggers": [{"selection": {"guid": "s1"}}, {"selection": {"guid": "s2"}}], "comboItems": [{"guid": "ci"}]}],
        "appliedServiceCharges": [{"guid": "sc", "serviceCharge": {"guid": "x"}, "appliedTax": [{"guid": "at"}]}],
        "selections": [{"guid": "s1", "item": {"guid": "i"}, "modifiers": [{"guid": "m", "item": {"guid": "mi"}}], "appliedTaxes": [{"guid": None, "rate": 0.1}], "appliedDiscounts": [{"guid": "sd", "triggers": [{"selection": {"guid": "s9"}}]}]}],
    }],
}


def test_pos_orders(records, rows_of):
    out = pos.shred_orders(records(json.dumps(ORDER)))
    head = out["orders"].first()
    assert head["id"] == "o" and head["server_id"] == "s" and head["diningOption_guid"] == "d" and head["createdDate"].year == 2024
    assert rows_of(out["orders_check_payment"]) == [("c", "p", "o", "r")]
    payment = out["payment"].first()
    assert payment["refund_tip_amount"] == 2 and payment["refundAmount"] == 1 and payment["void_info_approver_guid"] == "a"
    assert rows_of(out["orders_pricing_feature"], "pricing_feature") == [("A",), ("B",)]
    assert rows_of(out["orders_check_applied_discount_trigger"], "orders_check_applied_discount_id", "selection_id") == [("ad", "s1"), ("ad", "s2")]
    assert rows_of(out["orders_check_selection_modifier"], "id", "orders_check_selection_id", "item_id", "restaurant_id") == [("m", "s1", "mi", "r")]
    assert out["orders_check_selection_applied_tax"].first()["id"].startswith("gen-")
    assert len(out) == 15 and set(out) <= set(pos.SPECS)
    for name, df in out.items():
        assert set(pos.SPECS[name].pk) <= set(df.columns), name


def test_pos_config(records, rows_of):
    df = records('{"guid":"t","restaurant_id":"r","breaks":[{"guid":"b","breakType":{"guid":"bt"}}],"jobReference":{"guid":"j"}}')
    out = pos.shred_config("time_entry", df)
    assert rows_of(out["time_entry"], "id", "job_reference_id") == [("t", "j")]
    assert rows_of(out["break"], "id", "time_entry_id", "breakType_id") == [("b", "t", "bt")]
    out = pos.shred_config("employee", records('{"guid":"e","restaurant_id":"r","wageOverrides":[{"guid":"w","jobReference":{"guid":"j","entityType":"E"},"wage":5}]}'))
    assert rows_of(out["employee_wage_override"], "employee_id", "wage") == [("e", 5)]
    out = pos.shred_detail("restaurant_detail", records('{"restaurant_id":"r","general":{"name":"N"},"hours":{"h":1}}'))
    assert rows_of(out["restaurant_detail"], "restaurant_id", "general_name", "hours") == [("r", "N", '{"h":1}')]


def test_pos_menus(spark, rows_of):
    menu = {
        "restaurantGuid": "r", "lastUpdated": "2024-01-01",
        "menus": [{"guid": "m", "name": "M", "menuGroups": [{"guid": "g", "menuGroups": [{"guid": "h", "menuItems": [{"guid": "i", "name": "I", "modifierGroupReferences": [1, 2, 2]}]}]}]}],
        "modifierGroupReferences": {"1": {"guid": "x", "name": "Size"}, "note": "skip"},
    }
    df = spark.createDataFrame([("r", json.dumps(menu))], "restaurant_id string, j string").select("restaurant_id", F.parse_json("j").alias("menu"))
    out = pos.shred_menus(df)
    assert rows_of(out["menu_v2_menu_group"], "id", "menu_id", "parent_menu_group_id") == [("g", "m", None), ("h", "m", "g")]
    assert rows_of(pos.widen_fields(out["menu_v2_menu_item"], ["name"]), "id", "menu_group_id", "name") == [("i", "h", "I")]
    assert rows_of(out["menu_v2_item_modifier_group_ref"]) == [("r", "i", "1"), ("r", "i", "2")]
    assert rows_of(out["menu_v2_modifier_group"], "reference_id", "id") == [("1", "x")]
