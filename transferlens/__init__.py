"""transferlens: token-transfer analytics as PySpark DataFrame jobs.

Layout
------
functions   column expressions: exact 256-bit amounts, time predicates, distinct counts
sources     readers, decoders and writers for raw logs, transfers and token metadata
operators   reusable DataFrame operators: metadata join, ledger, exact quantiles
plans       the named analytics (activity, tokens, holders, discovery)
streaming   incremental ingest and streaming daily activity
"""
