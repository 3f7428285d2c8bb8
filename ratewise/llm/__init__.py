"""Operators for preparing training text at scale, and their registered queries.

Nothing outside this package imports it. Tables are given as DataFrames; the columns an operator reads are
named by parameters, and all other columns are ignored or passed on, so clashing names do no harm.
"""
