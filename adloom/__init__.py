"""Classified-listing analytics expressed as Spark DataFrame operations.

Sub-packages
------------
``functions``  column-to-column expressions (text, numbers, dates, media)
``sources``    readers, writers, schemas, catalogs and the source registry
``operators``  DataFrame-to-DataFrame operators (matching, dedup, gates, statistics, pages)
``plans``      whole pipelines composed from the operators, and the registered queries
``streaming``  the same operators over Structured Streaming feeds
"""
