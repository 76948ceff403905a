"""ferrum: Spark-native operators for connected-vehicle and contract data pipelines.

Every operator is a plain ``DataFrame -> DataFrame`` function (or a small
function that writes a DataFrame and returns a reader over the result).
Clocks are never read inside an operator: each one takes an explicit ``as_of``.
"""

__version__ = "0.1.0"
