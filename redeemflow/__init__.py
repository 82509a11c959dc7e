"""redeemflow: coupon-redemption analytics as lazy Spark DataFrame plans.

Every public operator takes DataFrames and returns a DataFrame built from
Spark's own functions; nothing is collected and no Python UDF sits on a
hot path.
"""

__version__ = "0.1.0"
