"""crease: head-to-head outcome analytics (batter against bowler) on Spark.

Every operator is a function from DataFrames to DataFrames built on Spark SQL
expressions and MLlib; nothing is collected to the driver except model
parameters whose size is fixed by the caller (k centres, two trees).
"""

__version__ = "0.1.0"
