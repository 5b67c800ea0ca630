"""Explicit schemas of the basket tables (no inference pass over the input).

Ids are 64-bit: 32-bit keys overflow at scale.
"""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

ORDERS = StructType(
    [
        StructField("order_id", LongType()),
        StructField("user_id", LongType()),
        StructField("eval_set", StringType()),
        StructField("order_number", IntegerType()),
        StructField("order_dow", IntegerType()),
        StructField("order_hour_of_day", IntegerType()),
        StructField("days_since_prior_order", DoubleType()),
    ]
)

# One split file (prior or train) of the reference layout.
ORDER_PRODUCTS = StructType(
    [
        StructField("order_id", LongType()),
        StructField("product_id", LongType()),
        StructField("add_to_cart_order", IntegerType()),
        StructField("reordered", IntegerType()),
    ]
)

# The unified fact: one row per item, labelled with the split it came from.
ORDER_ITEMS = StructType(ORDER_PRODUCTS.fields + [StructField("eval_set", StringType())])

PRODUCTS = StructType(
    [
        StructField("product_id", LongType()),
        StructField("product_name", StringType()),
        StructField("aisle_id", IntegerType()),
        StructField("department_id", IntegerType()),
    ]
)

AISLES = StructType([StructField("aisle_id", IntegerType()), StructField("aisle", StringType())])

DEPARTMENTS = StructType(
    [StructField("department_id", IntegerType()), StructField("department", StringType())]
)

# The split labels of the reference data.
PRIOR = "prior"
TRAIN = "train"
TEST = "test"
SPLITS = (PRIOR, TRAIN)
