"""Operators for preparing training text: thirteen operators, their queries, and helpers they share.

Nothing outside this package imports it; `__spark_entry__.py` adds its queries when it is present.
"""
