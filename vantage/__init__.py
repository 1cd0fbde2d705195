"""vantage: modelling analytics on Spark DataFrames.

Every public function takes DataFrames (plus column names and plain
parameters) and returns DataFrames.  Data-sized work runs on executors
through the DataFrame/SQL API and ``pyspark.ml``; only model-sized
results (centres, small matrices, the best candidate) reach the driver.
"""

__version__ = "0.1.0"
