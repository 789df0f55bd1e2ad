"""Reports composed from sources, functions and operators, one module per domain.

``registry`` maps every report key to its Spark callable and DuckDB oracle SQL.
"""
