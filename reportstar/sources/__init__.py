"""Raw inputs: the three feeds, from a catalog, from files, or derived from the test tables."""

from reportstar.sources.raw import RawTables
from reportstar.sources.testdata import derive_raw_tables

__all__ = ["RawTables", "derive_raw_tables"]
