"""DuckDB statements that state each registered query a second time, in SQL."""

from oracles.build import statements

__all__ = ["statements"]
