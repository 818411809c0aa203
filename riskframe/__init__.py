"""riskframe: tabular risk-scoring data work as PySpark DataFrame operators.

Layout
------
``spec``        column lists and constants of a scoring table
``schemas``     StructTypes of tables and JSON payloads
``functions``   column expressions (digests, draws, names, ratios)
``sources``     scans, sinks and table maintenance
``operators``   DataFrame -> DataFrame building blocks
``plans``       whole jobs composed from the operators
``streaming``   Structured Streaming forms of the incremental jobs
"""

from riskframe.spec import CREDIT, TableSpec

__all__ = ["CREDIT", "TableSpec"]
