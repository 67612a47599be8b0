"""DuckDB oracle SQL for the registered queries."""

from oracle.queries import ORACLE_SQL  # noqa: F401
