"""tillroll: a Spark-native retail warehouse and market-basket engine.

Every public operator is DataFrame-in, DataFrame-out.  Nothing on the data
path collects to the driver; the plans are left to Catalyst and AQE.
"""

__version__ = "0.1.0"
