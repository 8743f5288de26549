"""Market analytics on Spark.

Every operator takes DataFrames (plus keyword parameters) and returns a
DataFrame; nothing is collected inside an operator.  See the README for the map
from operator to module.
"""

__version__ = "0.1.0"
