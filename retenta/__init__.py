"""Customer-retention analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns DataFrames.  Work stays in Spark:
expressions, aggregates, windows, joins, Spark ML, and Arrow functions only
where no expression exists.
"""

__version__ = "0.1.0"
