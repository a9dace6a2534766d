"""paneltide: panel / time-series analytics expressed as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame``; the heavy part is a
distributed Spark aggregation, join or window.  Only small, bounded results
(a handful of rows, or a k x k matrix) are finished on the driver.
"""

__version__ = "0.1.0"
