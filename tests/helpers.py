import datetime as dt

from pyspark.sql import SparkSession

from redeemflow.sources import LOG_SCHEMA


def d(s):
    """'05-20' -> 2016-05-20."""
    if s is None:
        return None
    m, day = s.split("-")
    return dt.date(2016, int(m), int(day))


def log_df(spark: SparkSession, rows):
    """rows: (user, merchant, coupon, rate, distance, received 'MM-DD', date 'MM-DD')."""
    data = [(u, m, c, r, dist, d(rec), d(use)) for u, m, c, r, dist, rec, use in rows]
    return spark.createDataFrame(data, LOG_SCHEMA)
