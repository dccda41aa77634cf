"""Every operator and report as a named query over the test tables.

Each query is registered with the DuckDB statement that gives the same rows, unless SQL
cannot express it. ``bindings`` maps review roles onto the tables for both engines.
"""

from starmill.catalog import (  # noqa: F401
    aggregates,
    analyses,
    charts,
    cleaning,
    filters,
    joins,
    model,
    ranking,
    scalars,
    sql_reports,
    surfaces,
    text,
)
from starmill.catalog.registry import ORACLES, QUERIES  # noqa: F401
