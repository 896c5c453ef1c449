"""Every operator as a query over the given tables, with reference SQL."""

from . import (  # noqa: F401
    clean_queries, graph_queries, io_queries, scalar_queries, search_queries, store_queries,
    stream_queries, table_queries,
)
from .registry import QUERIES, SQL
from .views import Views

__all__ = ["QUERIES", "SQL", "Views"]
