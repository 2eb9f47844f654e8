"""Operators of a training-data pipeline: dedup, language, quality, mixing, packing, output.

Each module states its method and what it does with nulls, empty and long texts, ties, repeated rows,
empty tables and extra columns. Operators read only the columns they name, so extra columns, whatever
their names, neither reach a result nor clash with it.
"""
