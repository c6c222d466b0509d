"""tablelens: reporting and analytics over business tables, as Spark DataFrames.

Every public function takes DataFrames (or Columns) and returns a lazy
DataFrame (or Column); Catalyst decides how it runs.
"""

__version__ = "0.1.0"
