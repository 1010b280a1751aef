"""Payroll: employees with their sub-resources, pay runs, payslips with eight kinds of lines, timesheets."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recordloom.operators.flatten import as_json, at, stamp, strip_nulls
from recordloom.plans.base import shred_entity, typed_specs
from recordloom.spec import Child, Entity, TableSpec, parse_tables, struct_field

# Tables and their keys.
TABLES = """
payroll_leave_type: leaveTypeID
payroll_earning_rate: earningsRateID
payroll_deduction: deductionId
payroll_benefit: id
payroll_reimbursement: reimbursementID
payroll_settings: _singleton
payroll_employee: employeeID
payroll_employment: employeeID
payroll_employee_tax: employeeID
payroll_employee_opening_balance: employeeID
payroll_employee_leave: leaveID
payroll_employee_leave_balance: employeeID, leaveTypeID
payroll_employee_statutory_leave_balance: employeeID, leaveType
payroll_employee_pay_template: payTemplateEarningID
payroll_salary_and_wage: salaryAndWagesID
payroll_payment_method: employeeID
payroll_pay_run: payRunID
payroll_payslip: paySlipID
payroll_payslip_earning_line: paySlipID, earningsLineID
payroll_payslip_deduction_line: paySlipID, deductionLineID
payroll_payslip_leave_accrual_line: paySlipID, leaveAccrualLineID
payroll_payslip_reimbursement_line: paySlipID, reimbursementLineID
payroll_payslip_benefit_line: paySlipID, benefitLineID
payroll_payslip_tax_line: paySlipID, taxLineID
payroll_payslip_court_order_line: paySlipID, courtOrderLineID
payroll_payslip_payment_line: paySlipID, paymentLineID
payroll_timesheet: timesheetID
payroll_timesheet_line: timesheetID, timesheetLineID
payroll_earnings_order: id
"""
# Column types of the domain.
NUMBERS = """
amount annualSalary balance balanceRemaining fixedAmount grossEarnings multipleOfOrdinaryEarningsRate numberOfUnits
numberOfUnitsPerDay numberOfUnitsPerWeek percentage previousTaxPaid previousTaxablePay priorEmployeeNumber ratePerUnit
standardAmount statutoryAdoptionPay statutoryMaternityPay statutoryPaternityPay statutorySharedParentalPay
statutorySickPay totalBenefits totalCost totalCourtOrders totalDeductions totalEarnings totalEmployeeTaxes
totalEmployerTaxes totalHours totalPay totalReimbursements
"""
FLAGS = """
applyToPensionCalculations currentRecord excludedFromMinimumWage hasPostGraduateLoans isActive isAverageDailyPayRate
isCalculatingOnQualifyingEarnings isDirector isEmployerTax isLinkedToTimesheet isOffPayrollWorker isPaidLeave isPension
isReducedByBasicRate isStatutoryLeave manualAdjustment reducesSuperLiability reducesTaxLiability showBalanceToEmployee
showOnPayslip subjectToNIC subjectToPension subjectToTax
"""
# Line arrays of a payslip and their tables.
PAYSLIP_LINES = {
    "earningsLines": "payroll_payslip_earning_line",
    "deductionLines": "payroll_payslip_deduction_line",
    "leaveAccrualLines": "payroll_payslip_leave_accrual_line",
    "reimbursementLines": "payroll_payslip_reimbursement_line",
    "benefitLines": "payroll_payslip_benefit_line",
    "taxLines": "payroll_payslip_tax_line",
    "courtOrderLines": "payroll_payslip_court_order_line",
    "paymentLines": "payroll_payslip_payment_line",
}
# Nested fields that are kept as JSON.
JSON_FIELDS = {
    "payroll_employee": ("address",),
    "payroll_settings": ("accounts",),
    "payroll_employee_leave": ("periods",),
    "payroll_payment_method": ("bankAccounts",),
    "payroll_timesheet_line": ("timesheetEarningsLines",),
}

SPECS: dict[str, TableSpec] = typed_specs(
    parse_tables(TABLES, sparse=True).values(),
    {**dict.fromkeys(NUMBERS.split(), "double"), **dict.fromkeys(FLAGS.split(), "boolean")},
)


def _entity(table: str) -> Entity:
    if table == "payroll_payslip":
        children = tuple(
            Child(array, name, (("paySlipID", "paySlipID"),), own_key=array.removesuffix("Lines") + "LineID")
            for array, name in PAYSLIP_LINES.items()
        )
    elif table == "payroll_timesheet":
        children = (
            Child(
                "timesheetLines", "payroll_timesheet_line", (("timesheetID", "timesheetID"),), own_key="timesheetLineID", style="plain"
            ),
        )
    else:
        children = ()
    drop = ("paySlips",) if table == "payroll_pay_run" else ()
    return Entity(SPECS[table], "scalars", drop=drop, children=children, slash_dates=True)


def shred(table: str, records: DataFrame, **context) -> dict[str, DataFrame]:
    """Tables of one kind of payroll record; sub-resources get ``employeeID`` as context."""
    for name in JSON_FIELDS.get(table, ()):
        f = struct_field(records.schema, name)
        if f is not None:
            records = records.withColumn(name, as_json(at(name), f.dataType))
    if table == "payroll_settings":
        records = stamp(records, _singleton="settings")
    out = shred_entity(_entity(table), records, SPECS, **context)
    for name, spec in SPECS.items():
        if name in out and "present" not in out[name].columns:
            out[name] = strip_nulls(out[name], spec.pk)
    return out
