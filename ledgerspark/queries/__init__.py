"""Driver bindings: one function and one DuckDB statement per query."""

from ledgerspark.queries import asof, closing, further, more, rows, screens, tables, values, windows  # noqa: F401
from ledgerspark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
