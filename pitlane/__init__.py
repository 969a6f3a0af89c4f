"""pitlane: Spark-native lap, tyre and strategy analytics.

Every operator is a function from DataFrame(s) to DataFrame built on Spark's
DataFrame, SQL and ML APIs, so the same code runs on one race or many seasons.
"""

__version__ = "0.1.0"
