"""dosecast: Spark-native expiry analytics.

Estimates how many doses of stock will expire unused in dispensing devices,
re-expressed as DataFrame / Spark SQL jobs, plus a group of segment and pixel
table operators.  Every public function takes DataFrames and returns a
DataFrame; nothing is collected to the driver.
"""

from dosecast.params import Params

__all__ = ["Params"]
