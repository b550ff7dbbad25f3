"""barloom: a Spark library for daily stock and option bars.

Every operator takes DataFrames and returns a DataFrame; jobs chain operators
and write tables through :class:`barloom.sources.warehouse.Warehouse`.
"""

__version__ = "0.1.0"
