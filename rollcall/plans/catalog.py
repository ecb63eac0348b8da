"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.plans import clock, loads, people, tables, vouchers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        people.month_dimension, people.turnover_monthly, people.turnover_report, people.headcount_monthly, people.active_days,
        people.headcount_snapshots, people.active_on_snapshots, people.events_on_leave,
        people.scheduled_hours, people.absence_hours, people.absenteeism_rate, people.absenteeism_split,
        people.medical_days, people.unexcused_days, people.absence_days_cycle, people.shift_catalogue_check,
        people.shift_catalogue_outer, people.terminated_employees, people.new_employees, people.erp_normalize,
        people.employee_registry, people.admitted_between, people.registry_segment, people.current_leave,
        people.latest_leave, people.leave_payment,
        vouchers.shift_class, vouchers.admission_prorata, vouchers.benefit_base_food,
        vouchers.benefit_base_meal_ticket, vouchers.benefit_base_meal_sheet, vouchers.benefit_base_meal_card,
        vouchers.benefit_enrich, vouchers.corrected_days, vouchers.basket_rule, vouchers.payment_routing,
        vouchers.abandonment_split,
        clock.event_ledger, clock.event_report, clock.event_pivot, clock.afd_parse, clock.duplicate_punches,
        clock.matched_punches, clock.unmatched_punches, clock.work_date_shift, clock.punch_reconciliation,
        clock.punches_missing_in_erp, clock.daily_punch_list, clock.daily_punch_entries, clock.event_list_pivot, clock.punch_parity, clock.attendance_grid,
        clock.timesheet, clock.import_rows, clock.import_rows_keep_date, clock.pending_punches,
        clock.pending_punches_by_day, clock.surrogate_ids, clock.stream_clockings, clock.stream_rejects, clock.punch_load, clock.stream_pending_by_day,
        loads.high_water_mark, loads.new_files, loads.new_sheets, loads.payroll_ingest, loads.payroll_rejects, loads.stream_payroll,
        loads.all_text, loads.receipt_extract, loads.receipt_rejects, loads.text_markers, loads.consent_register,
        loads.consent_rejects, loads.first_order, loads.last_order, loads.repeated_texts, *tables.QUERIES,
    )
}
