"""keyloom: curated, keyed analytics tables built with PySpark DataFrames."""

__version__ = "0.1.0"
