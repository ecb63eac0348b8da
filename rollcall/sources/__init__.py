"""Readers: ERP and warehouse tables, dimension sheets, punch JSON, AFD text, payroll files and receipt pages."""
