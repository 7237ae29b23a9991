"""Fixed schemas, so that no reader ever infers one from the data."""

from pyspark.sql import types as T

# Text formats default to milliseconds, which would change hashes and order.
TIME_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

POST = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("feed_pos", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("likes", T.LongType()),
    T.StructField("retweets", T.LongType()),
    T.StructField("replies", T.LongType()),
    T.StructField("total_engagement", T.LongType()),
    T.StructField("mentions", T.ArrayType(T.StringType())),
    T.StructField("hashtags", T.ArrayType(T.StringType())),
    T.StructField("hashtag_source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("scraped_at", T.TimestampType()),
    T.StructField("content_length", T.IntegerType()),
    T.StructField("hashtag_count", T.IntegerType()),
    T.StructField("mention_count", T.IntegerType()),
    T.StructField("hash", T.StringType()),
])

PROVIDER_RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("feed_pos", T.LongType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("full_text", T.StringType()),
    T.StructField("user", T.StructType([T.StructField("screen_name", T.StringType())])),
    T.StructField("favorite_count", T.LongType()),
    T.StructField("retweet_count", T.LongType()),
    T.StructField("reply_count", T.LongType()),
    T.StructField("hashtag_source", T.StringType()),
])
