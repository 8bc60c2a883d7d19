"""tillstream — a PySpark-native retail change-data and click-log warehouse.

Every operator is a plain ``DataFrame -> DataFrame`` function.  Stateless
operators run unchanged on batch and streaming DataFrames; stateful ones have
a batch form (aggregates / joins that Catalyst plans) and a streaming form
(watermarked aggregation, stream-stream joins or ``transformWithStateInPandas``).
"""

__version__ = "0.1.0"
