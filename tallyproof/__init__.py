"""Data-quality, reconciliation and load-history operators for ledger tables, written for Spark.

``functions``  column expressions and plan helpers
``operators``  DataFrame -> DataFrame building blocks
``sources``    readers, writers and table-layout upkeep
``plans``      whole jobs, and the queries that run over the supplied tables
"""
