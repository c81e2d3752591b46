"""tidewatch — trend and content-monitoring analytics on Spark DataFrames.

Every public function takes DataFrames (plus plain parameters) and returns
DataFrames; all heavy work is expressed with Spark SQL functions, joins,
aggregations and windows so Catalyst plans it.
"""

__version__ = "0.1.0"
