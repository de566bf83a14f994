"""Every operator as a query over the driver's tables, with the same result stated in SQL."""

from stayflow.queries import activity, orders, stays  # noqa: F401  (registers the queries)
from stayflow.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
