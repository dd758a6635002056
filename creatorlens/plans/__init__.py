"""Compositions of operators over the driver's tables (see FIXTURES.md §2).

``catalog.QUERIES`` maps a query name to ``fn(spark, sf_dir) -> DataFrame``;
``oracle.SQL`` holds the equivalent DuckDB SQL for the checkable ones.
"""
