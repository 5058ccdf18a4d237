"""Media-exposure analytics on Spark: operators, sources, functions, plans and streams."""

__version__ = "0.1.0"
