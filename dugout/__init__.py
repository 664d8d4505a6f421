"""Sports-analytics warehouse library on Spark DataFrames.

Sub-packages: ``functions`` (column expressions), ``operators`` (DataFrame to
DataFrame transforms), ``sources`` (landed payloads and tables), ``plans`` (the
model graph and the read queries), ``quality`` (tests, audits, comparisons) and
``streaming`` (incremental refresh).
"""
