"""Workforce, time-clock and payroll analytics on the Spark DataFrame API."""
