"""Where results go: full-refresh and append tables, views, and a checked JDBC export."""

from reportstar.sinks.runs import RunStore
from reportstar.sinks.store import (
    CatalogStore,
    Store,
    TableStore,
    cut_lineage,
    replace_view,
    shared_folder,
)

__all__ = ["CatalogStore", "RunStore", "Store", "TableStore", "cut_lineage", "replace_view", "shared_folder"]
