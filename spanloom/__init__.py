"""spanloom: a PySpark engine for staged, content-addressed text analytics."""

__version__ = "0.1.0"
