"""skylens: Spark-native analytics for streams and tables of moving-object observations.

Every operator is a ``DataFrame -> DataFrame`` function built from native Spark
expressions so Catalyst can push filters, prune columns and keep whole-stage
codegen; none of them moves data through the driver.
"""

__version__ = "0.1.0"
