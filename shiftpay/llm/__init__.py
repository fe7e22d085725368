"""Operators for preparing training text: ten operators and the queries that apply them.

Nothing else in the package imports this one. Operators take and return DataFrames and
own no state; what they write goes to the shared folder of ``spark.checkpoint.dir``.
"""
