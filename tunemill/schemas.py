"""Fixed schemas."""

from pyspark.sql import types as T

EXAMPLE = T.StructType([
    T.StructField("instruction", T.StringType(), True),
    T.StructField("input", T.StringType(), True),
    T.StructField("output", T.StringType(), True),
])

# instruction records as they travel between jobs (JSON files, mixes)
SOURCED_EXAMPLE = T.StructType([
    T.StructField("source", T.StringType(), True),
    T.StructField("example_id", T.StringType(), True),
    T.StructField("instruction", T.StringType(), True),
    T.StructField("input", T.StringType(), True),
    T.StructField("output", T.StringType(), True),
])

TURNS = T.StructType([
    T.StructField("conv_id", T.LongType(), True),
    T.StructField("turn", T.LongType(), True),
    T.StructField("role", T.StringType(), True),
    T.StructField("text", T.StringType(), True),
])

IDS = T.ArrayType(T.LongType(), False)
