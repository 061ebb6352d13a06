"""Entity histories and trend tables on Spark DataFrames."""

from annalist.spec import ESTABLISHMENTS, ColumnSpec, TableSpec

__all__ = ["ESTABLISHMENTS", "ColumnSpec", "TableSpec"]
