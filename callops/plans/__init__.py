"""Reporting plans.

The formulas behind the reporting columns are this package's own definitions; every threshold is
an argument.
"""
