"""stratum: multivariate analytics of entity-by-time tables on Spark.

Operators take and return DataFrames.  Heavy work is a distributed pass that
builds sufficient statistics; only k x k algebra (k = number of features)
runs on the driver.
"""

__version__ = "0.1.0"
