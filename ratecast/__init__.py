"""ratecast: irregular time-series rate analytics on Spark DataFrames.

Every public operator is a function ``DataFrame -> DataFrame`` (or a Column
expression) built from Spark SQL built-ins, so Catalyst sees the whole plan.
"""

__version__ = "0.1.0"
