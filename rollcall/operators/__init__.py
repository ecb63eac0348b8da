"""DataFrame operators.

Frames use one set of column names: ``branch``, ``emp_no``, ``admission``, ``termination``, ``cost_centre``, ``shift``
and so on. Dates are dates, absent values are NULL and soft-deleted rows are gone (see ``sources.erp.normalize``).
"""
