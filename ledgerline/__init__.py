"""ledgerline: a Spark-native batch engine for monthly payment records.

Layers: raw files -> Bronze (audited strings) -> Silver (typed, valid,
deduplicated) -> Gold (aggregates) -> reports and quality checks.
"""

__version__ = "0.1.0"
