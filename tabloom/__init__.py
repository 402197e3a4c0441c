"""tabloom: profile, prepare, model and analyse tables and time series on Spark.

Every operator takes and returns DataFrames.  Operators that learn something
(`fit_*`) keep only bounded facts on the driver (thresholds, category tables
below a checked size) and leave everything that grows with the data in Spark.
"""

__version__ = "0.1.0"
