"""Shift and payroll analytics as Spark DataFrame operators.

Every operator is a function from DataFrames (plus parameters) to a DataFrame.
Nothing here runs a job by itself except the sinks and the pipeline runs in
``shiftpay.plans.pipeline`` and ``shiftpay.streaming``.
"""
