"""candela: price-series analytics on PySpark.

Every public function takes and returns Spark DataFrames; the work runs as
Spark jobs (scans, shuffles, windows).  See README.md for the design.
"""

__version__ = "0.1.0"
