"""Operators for preparing training text: de-duplication, filters, scans, decontamination and packing.

Nothing else in the library imports this package. Every operator is a function of DataFrames; ``queries`` registers
one query for each.
"""
