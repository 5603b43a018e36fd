"""Curbline: Spark-native analytics for civic service requests.

Every public function takes and returns DataFrames (or Columns); Catalyst plans across them.
"""
