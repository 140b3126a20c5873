"""Fixed row types of the reference's jobs as Spark schemas."""
from pyspark.sql import types as T

# Click event: user, action, times (epoch ms).
EVENT = T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("times", T.LongType()),
])

# App-side payment: order id, channel, epoch ms.
PAYMENT_APP = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("ts", T.LongType()),
])

# Third-party payment: order id, channel, status, epoch ms.
PAYMENT_THIRD = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("ts", T.LongType()),
])

# Per-user timed item (orders on one side, activities on the other).
USER_ITEM = T.StructType([
    T.StructField("user", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("ts", T.LongType()),
])

# Driver `events` table as stored.
DRIVER_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
