"""flightlake: Spark-native air-traffic analytics.

Every public function takes and returns Spark DataFrames (or Column
expressions); nothing is collected to the driver.
"""

__version__ = "0.1.0"
