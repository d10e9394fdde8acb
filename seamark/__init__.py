"""Seamark: forecast-skill analytics as PySpark DataFrame operators.

Every operator takes DataFrames and returns a lazy DataFrame.  Missing values
are SQL NULL, times are UTC, and ``keys`` name the columns of one series.
"""

__version__ = "0.1.0"
