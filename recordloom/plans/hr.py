"""HR: forms found at run time, attendance, leave, time tracking, cases, learning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.scalars import first_truthy, parse_dmy
from recordloom.operators.flatten import keep_raw
from recordloom.operators.keys import require_key
from recordloom.operators.merge import reject_log
from recordloom.operators.shred import (
    auto_children,
    derive_dim,
    explode_dated_map,
    tagged_union,
    with_position,
)
from recordloom.plans.base import first_field, pick_columns
from recordloom.spec import Policy, TableSpec, parse_tables

# Tables and their keys.
SPECS: dict[str, TableSpec] = parse_tables(
    """
    forms_meta: form_link_name
    views_meta: form_link_name, view_name
    form_fields: form_link_name, field_label
    file_categories: file_category_id
    files: file_id
    holidays: id
    leave_types: id
    attendance_daily: employee_id, date
    leave_records: id
    leave_records_days: leave_id, date
    leave_balance: employee_id, leave_type_id, from_date, to_date
    jobs: job_id
    timetracker_clients: client_id
    timetracker_projects: project_id
    attendance_entries: employee_id, date
    attendance_entries_punches: employee_id, date, punch_idx
    attendance_latest_entries: employee_id, date, entry_idx
    shift_mappings: employee_id, date
    cases: case_id
    announcements: announcement_id
    courses: course_id
    learner_progress: learner_id, course_id
    """
) | {
    "timelogs": TableSpec("timelogs", ("timelog_id",), policy=Policy.WINDOW, cursor=("work_date",), window_days=180),
    "timesheets": TableSpec("timesheets", ("timesheet_id",), policy=Policy.WINDOW, cursor=("from_date",), window_days=180),
    "attendance_regularization": TableSpec(
        "attendance_regularization", ("record_id",), policy=Policy.WINDOW, cursor=("start_date",), window_days=180
    ),
}
RECORD_IDS = ("recordId", "Zoho_ID", "ZohoID", "id", "ID", "EntityId")

# Columns by table, taken from the field of the same name in camel case.
COLUMNS = {
    "jobs": """job_id job_name description job_status project_id project_name client_id client_name from_date to_date
        estimated_hours logged_hours billable_status rate_per_hour owner assigned_by""",
    "timelogs": """timelog_id erecno employee_email employee_first_name employee_last_name type work_date hours total_time
        from_time to_time from_time_fmt to_time_fmt job_id job_name project_id project_name client_id client_name
        billing_status approval_status billed_status is_pushed_to_qbo""",
    "courses": "course_id name description course_type status",
    "timetracker_clients": """client_id client_name currency_code billing_method email_id first_name last_name phone_no
        mobile_no fax_no street_addr city state pincode country industry comp_size description""",
    "timetracker_projects": """project_id project_name project_status project_cost client_id client_name owner_id owner_name
        project_head_emp_id project_head_name project_head_rate user_count job_count managers users departments""",
    "timesheets": """timesheet_id timesheet_name employee_name employee_email from_date to_date status billable_hours
        non_billable_hours total_hours approved_billable_hours approved_total_hours rate_per_hour total_amount
        approved_total_amount currency""",
    "attendance_regularization": "record_id approval_status employee_name employee_id start_date end_date reg_details",
    "cases": """case_id record_id subject status status_id category_name category_id agent_name agent_id requestor_name
        requestor_id sla has_attachment created_time""",
    "announcements": """announcement_id subject message owner publish_date expire_date is_active is_sticky
        is_comment_disable is_notify modified_time notify_others_emails""",
    "learner_progress": """learner_id course_id course_name course_type batch_id batch_name enrolled_date completion_date
        completion_percentage completion_status completed_entities total_entities manager_evaluation_marks""",
    "holidays": """id name date location_id location_name shift_id shift_name is_half_day is_restricted session remarks""",
}
# Fields that do not follow the naming rule.
SOURCES: dict[str, dict[str, tuple[str, ...]]] = {
    "jobs": {
        "job_id": ("jobId", "JobId", "id"), "estimated_hours": ("hours",), "logged_hours": ("totalhours",),
        "billable_status": ("jobBillableStatus", "billingStatus"),
    },
    "timelogs": {
        "timelog_id": ("timelogId", "TimelogId", "id"), "employee_email": ("employeeMailId",),
        "total_time": ("totaltime", "totalTime"), "from_time_fmt": ("fromTimeInTimeFormat",),
        "to_time_fmt": ("toTimeInTimeFormat",), "is_pushed_to_qbo": ("isTimelogPushedToQBO",),
    },
    "courses": {"course_id": ("courseId", "id"), "name": ("courseName", "name"), "course_type": ("courseType", "type")},
    "timetracker_clients": {"client_id": ("clientId", "ClientId", "id"), "comp_size": ("compsize",)},
    "timetracker_projects": {
        "project_id": ("projectId", "id"), "project_head_emp_id": ("projectHead.empId",),
        "project_head_name": ("projectHead.name",), "project_head_rate": ("projectHead.rate",),
        "user_count": ("projectUsersCount",), "managers": ("projectManagers",), "users": ("projectUsers",),
        "departments": ("projectDepts",),
    },
    "timesheets": {"timesheet_id": ("recordId", "timesheetId", "id"), "non_billable_hours": ("nonbillableHours",)},
    "attendance_regularization": {"record_id": ("recordId", "id")},
    "cases": {
        "case_id": ("caseId", "recordId", "id"), "record_id": ("recordId", "caseId", "id"), "agent_name": ("agent.name",),
        "agent_id": ("agent.erecno", "agent.empId"), "requestor_name": ("requestor.name",),
        "requestor_id": ("requestor.erecno", "requestor.empId"), "sla": ("SLA", "sla"),
    },
    "announcements": {"announcement_id": ("announcementId", "id"), "notify_others_emails": ("notifyOthersEmailIds",)},
    "learner_progress": {
        "learner_id": ("learner_id",), "course_id": ("courseId", "id"), "completed_entities": ("completedEntitiesCount",),
        "total_entities": ("totalEntitiesCount",),
    },
    "holidays": {
        "id": ("Id", "id"), "name": ("Name",), "date": ("Date", "HolidayDate"), "is_half_day": ("isHalfday", "IsHalfday"),
        "is_restricted": ("isRestrictedHoliday", "IsRestrictedHoliday"), "session": ("Session",), "remarks": ("Remarks",),
    },
}
LEAVE_COLUMNS = """id leave_type_id leave_type_name unit type approval_status employee_name employee_id_name employee_email
    from_date to_date reason applied_date applied_by employee_photo"""
LEAVE_SOURCES = {
    "id": ("Zoho.ID", "recordId", "LeaveID", "leaveId", "id"),
    "leave_type_id": ("Leavetype.ID", "LeaveType.ID", "leaveTypeId"),
    "leave_type_name": ("Leavetype", "LeaveType", "leaveTypeName"),
    "unit": ("Unit", "unit"),
    "type": ("Type", "type"),
    "employee_name": ("Employee", "employee"),
    "employee_id_name": ("EmployeeId", "employeeId"),
    "employee_email": ("TeamEmailID", "EmailID", "Email", "emailId"),
    "from_date": ("From", "from", "fromDate"),
    "to_date": ("To", "to", "toDate"),
    "reason": ("Reason", "reason"),
    "employee_photo": ("EmployeePhoto",),
}
DAY_COLUMNS = {
    "working_hours": ("WorkingHours",), "total_hours": ("TotalHours", "totalHrs"), "over_time": ("OverTime",),
    "deviation_time": ("DeviationTime",), "status": ("Status",), "shift_name": ("ShiftName",),
    "first_in": ("FirstIn", "firstIn"), "last_out": ("LastOut", "lastOut"), "paid_break": ("paidBreak",),
    "unpaid_break": ("unPaidBreak",),
}
EMPLOYEE_SOURCES = {
    "employee_id": ("EmployeeID", "employeeId", "erecno", "Erecno"),
    "erecno": ("Erecno", "erecno", "zuid"),
    "employee_email": ("EmployeeMailID", "emailId", "EmailID"),
    "employee_first_name": ("FirstName", "firstName"),
    "employee_last_name": ("LastName", "lastName"),
}
PUNCH_SOURCES = {
    "check_in_location": ("checkIn_Location",), "check_out_location": ("checkOut_Location",),
}
LATEST_SOURCES = ("attEntries", "singleRegEntries", "multiRegEntries")


def _required(df: DataFrame, table: str, rejects: list[DataFrame] | None, pk: tuple[str, ...] | None = None) -> DataFrame:
    """Rows with their key; those that lack it go to ``rejects`` (table, reason, fields) when the caller keeps such a list."""
    good, lacking = require_key(df, pk or SPECS[table].pk)
    if rejects is not None:
        rejects.append(reject_log(lacking, table))
    return good


def shred_form(table: str, records: DataFrame, rejects: list[DataFrame] | None = None) -> dict[str, DataFrame]:
    """Records of one form and its tabular sections, keyed by ``record_id``."""
    ids = [F.col(f"`{k}`").cast("string") for k in RECORD_IDS if k in records.columns]
    keyed = _required(records.withColumn("record_id", F.coalesce(*ids)), table, rejects, ("record_id",))
    return auto_children(
        keyed, table, "record_id", "parent_record_id", "record_id", style="display", id_keys=RECORD_IDS
    )


def rows(table: str, records: DataFrame, rejects: list[DataFrame] | None = None) -> DataFrame:
    """Rows of a table whose columns follow the naming rule; rows without a key go to ``rejects``."""
    names = COLUMNS[table].split()
    raw = "raw_meta" if table == "holidays" else "raw_record"
    picked = pick_columns(records, names, SOURCES.get(table), raw)
    return _required(picked, table, rejects)


def _dotted(records: DataFrame) -> DataFrame:
    """Field names that contain a dot are data here, not paths."""
    return records.withColumnsRenamed({c: c.replace(".", "__") for c in records.columns if "." in c})


def shred_leave(records: DataFrame, rejects: list[DataFrame] | None = None) -> dict[str, DataFrame]:
    """Leave records, their days, and the leave types they mention (first mention wins)."""
    # the record as it came, before names with dots are changed
    records = _dotted(keep_raw(records))
    sources = {n: tuple(s.replace(".", "__") for s in options) for n, options in LEAVE_SOURCES.items()}
    picked = pick_columns(records, [*LEAVE_COLUMNS.split(), "raw_record"], {**sources, "raw_record": ("raw_record",)}, raw=None)
    leave = _required(picked, "leave_records", rejects)
    leave = leave.withColumn("employee_id_name", F.trim("employee_id_name"))
    out = {"leave_records": leave}
    days = next((c for c in ("Days", "days") if c in records.columns), None)
    if days:
        ids = [F.col(f"`{k}`").cast("string") for k in sources["id"] if k in records.columns]
        keyed = records.select(first_truthy(*ids).alias("leave_id"), F.col(days).alias("days")).filter("leave_id is not null")
        daily = explode_dated_map(keyed, "days", ["leave_id"])
        picked = pick_columns(daily, ["leave_id", "date", "leave_count", "start_time", "end_time"], {"leave_id": ("leave_id",)}, "raw_meta")
        out["leave_records_days"] = picked
    types = derive_dim(leave, "leave_type_id", ["leave_type_name", "unit", "type"], ["id"])
    out["leave_types"] = types.withColumnsRenamed({"leave_type_id": "id", "leave_type_name": "name"})
    return out


def leave_balance(reports: DataFrame, from_date: str, to_date: str) -> DataFrame:
    """``report map<employee, map<type, struct<booked, balance, available, unit>>>`` to one row per employee, type and window.

    Where the report lists its ``employees``, only theirs count, each once. A missing unit is ``Day``; ``raw_vals`` keeps the figures as they came.
    """
    if "employees" in reports.columns:
        # two maps meet by a hash of their keys; a search of the list for each key would be quadratic
        names = F.array_distinct(F.array_compact(F.col("employees").cast("array<string>")))
        listed = F.map_from_entries(F.transform(names, lambda e: F.struct(e, F.lit(True))))
        reports = reports.withColumn("report", F.map_zip_with("report", listed, lambda k, v, there: F.when(there, v)))
    entries = reports.select(F.explode("report").alias("employee_id", "_m")).select("employee_id", F.explode("_m").alias("leave_type_id", "_v"))
    names = entries.schema["_v"].dataType.fieldNames()

    def value(name: str) -> Column:
        return F.col(f"_v.{name}") if name in names else F.lit(None).cast("string")

    return entries.filter("_v is not null").select(
        "employee_id", "leave_type_id", F.lit(from_date).alias("from_date"), F.lit(to_date).alias("to_date"),
        *(value(n).alias(n) for n in ("booked", "balance", "available")),
        F.coalesce(F.nullif(value("unit").cast("string"), F.lit("")), F.lit("Day")).alias("unit"),
        F.to_json("_v").alias("raw_vals"),
    )


def balance_tables(reports: DataFrame, from_date: str, to_date: str, known: DataFrame | None = None) -> dict[str, DataFrame]:
    """Balances of a report and the leave types it names, without those of ``known`` (leave types met before)."""
    out = {"leave_balance": leave_balance(reports, from_date, to_date)}
    if "leavetypes" in reports.columns:
        types = reports.select(F.explode("leavetypes").alias("id", "_t")).filter("_t is not null")
        fields = types.schema["_t"].dataType.fieldNames()
        named = types.select("id", *((F.col(f"_t.{n}") if n in fields else F.lit(None).cast("string")).alias(n) for n in ("name", "unit", "type")))
        types = derive_dim(named, "id", ["name", "unit", "type"], ["name", "unit", "type"])
        out["leave_types"] = types if known is None else types.join(known.select("id"), "id", "left_anti")
    return out


def attendance_daily(records: DataFrame, rejects: list[DataFrame] | None = None) -> DataFrame:
    """``employeeDetails`` and a date-keyed ``attendanceDetails`` map to one row per employee and day."""
    prefix = "employeeDetails." if "employeeDetails" in records.columns else ""
    people = {n: tuple(prefix + s for s in options) for n, options in EMPLOYEE_SOURCES.items()}
    both = records.select(
        *[first_field(records, options).alias(n) for n, options in people.items()],
        F.col("attendanceDetails").alias("days"),
    )
    daily = explode_dated_map(both, "days", list(people))
    columns = {**{n: (n,) for n in (*people, "date")}, **DAY_COLUMNS}
    return _required(pick_columns(daily, list(columns), columns, "raw_day"), "attendance_daily", rejects)


def punches(records: DataFrame) -> DataFrame:
    """``employee_id, date, entries[]`` to one row per punch with its position."""
    positioned = with_position(records.select("employee_id", "date", "entries"), "entries", "punch_idx", "p")
    flat = positioned.select("employee_id", "date", "punch_idx", "p.*")
    names = [
        "employee_id", "date", "punch_idx", "check_in", "check_out", "check_in_location", "check_out_location",
        "source_of_punch_in", "source_of_punch_out",
    ]
    sources = {"employee_id": ("employee_id",), "punch_idx": ("punch_idx",), **PUNCH_SOURCES}
    return pick_columns(flat, names, sources, "raw_punch")


def latest_entries(records: DataFrame) -> DataFrame:
    """``employee_id, entries map<date, struct of three lists>`` to one row per entry and list."""
    daily = explode_dated_map(records, "entries", ["employee_id"])
    return tagged_union(daily, {s: s for s in LATEST_SOURCES}, "source", ["employee_id", "date"], position="entry_idx")


def shift_mappings(records: DataFrame, rejects: list[DataFrame] | None = None) -> DataFrame:
    """``employee_id, shiftList[]`` to one row per day; vendor dates become ISO."""
    shifts = records.select("employee_id", F.explode("shiftList").alias("s")).select("employee_id", "s.*")
    names = ["employee_id", "date", "shift_name", "shift_start_time", "shift_end_time", "weekend", "holiday"]
    sources = {
        "employee_id": ("employee_id",), "date": ("date", "Date", "shiftDate"), "shift_name": ("shiftName", "ShiftName", "name"),
        "shift_start_time": ("startTime", "StartTime"), "shift_end_time": ("endTime", "EndTime"),
        "weekend": ("weekend", "Weekend"), "holiday": ("holiday", "Holiday"),
    }
    picked = pick_columns(shifts, names, sources).withColumn("date", parse_dmy("date"))
    return _required(picked, "shift_mappings", rejects)
