"""Golden inputs (FIXTURES.md): small deterministic event sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql.types import (
    IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from eventflow import schemas as S

GAME_BASE = dt.datetime(2022, 9, 6)
CART_BASE = dt.datetime(2022, 9, 8)

GAME_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("event_type", StringType()),
    StructField("ts", TimestampNTZType()), StructField("player_id", StringType()),
    StructField("nickname", StringType()),
])

CART_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("event_type", StringType()),
    StructField("user_id", StringType()), StructField("sku", StringType()),
    StructField("quantity", IntegerType()), StructField("ts", TimestampNTZType()),
])


def sec(base, s):
    return base + dt.timedelta(seconds=s)


def game_events(spark):
    """12 events (id, second, type, nickname)."""
    R, O = S.REGISTERED, S.ONLINE
    rows = [(0, 2, R, "bob"), (1, 2, O, "bob"), (2, 3, R, "sam"), (3, 4, O, "sam"),
            (4, 4, R, "rob"), (5, 4, R, "alice"), (6, 6, R, "mary"), (7, 6, O, "mary"),
            (8, 8, R, "carl"), (9, 10, O, "rob"), (10, 10, O, "alice"), (11, 10, O, "carl")]
    data = [(i, t, sec(GAME_BASE, s), f"id-{n}", n) for i, s, t, n in rows]
    return spark.createDataFrame(data, GAME_SCHEMA)


def cart_batches(spark):
    """five Add rows at each of s = 0, 5, 10, 15, 20."""
    users = ["Bob", "Alice", "Sam", "Tom", "Diana"]
    data = [(i, S.ADD, users[i % 5], f"sku-{i}", i % 10, sec(CART_BASE, 5 * (i // 5))) for i in range(25)]
    return spark.createDataFrame(data, CART_SCHEMA)


def cart_mixed(spark):
    """Add and Removed rows."""
    A, Rm = S.ADD, S.REMOVED
    rows = [(0, 0, "Bob", A, 1), (1, 1, "Alice", Rm, 9), (2, 2, "Bob", Rm, 2),
            (3, 3, "Bob", A, 7), (4, 4, "Alice", A, 0), (5, 5, "Bob", A, 6)]
    data = [(i, t, u, f"sku-{i}", q, sec(CART_BASE, s)) for i, s, u, t, q in rows]
    return spark.createDataFrame(data, CART_SCHEMA)


def rules(spark):
    """threshold values 2, 0, 4, 5, 6, 3 at s = 1..6."""
    schema = StructType([StructField("rule_name", StringType()), StructField("effective_ts", TimestampNTZType()),
                         StructField("value", IntegerType()), StructField("rule_id", LongType())])
    vals = [2, 0, 4, 5, 6, 3]
    return spark.createDataFrame([("quantity-threshold", sec(CART_BASE, i + 1), v, i) for i, v in enumerate(vals)],
                                 schema)


def interval_pairs(spark):
    """one left row (Bob at 10 s); right rows around it."""
    ls = StructType([StructField("left_id", LongType()), StructField("user_id", StringType()),
                     StructField("sku", StringType()), StructField("quantity", IntegerType()),
                     StructField("ts", TimestampNTZType())])
    rs = StructType([StructField("right_id", LongType()), StructField("r_user_id", StringType()),
                     StructField("product_id", StringType()), StructField("right_ts", TimestampNTZType())])
    left = spark.createDataFrame([(100, "Bob", "boots", 1, sec(CART_BASE, 10))], ls)
    right = spark.createDataFrame([
        (1, "Bob", "p1", sec(CART_BASE, 8)), (2, "Bob", "p2", sec(CART_BASE, 8.001)),
        (3, "Bob", "p3", sec(CART_BASE, 10)), (4, "Bob", "p4", sec(CART_BASE, 11.999)),
        (5, "Bob", "p5", sec(CART_BASE, 12)), (6, "Alice", "p6", sec(CART_BASE, 10))], rs)
    return left, right


def trigger_window(spark, first=10, second=10):
    """F8: rows in one 5 s window, then rows in the next."""
    schema = StructType([StructField("event_id", LongType()), StructField("ts", TimestampNTZType())])
    rows = [(i, sec(CART_BASE, i * 0.4)) for i in range(first)]
    rows += [(100 + i, sec(CART_BASE, 5 + i * 0.4)) for i in range(second)]
    return spark.createDataFrame(rows, schema)


PERSON_SCHEMA = StructType([StructField("name", StringType()), StructField("age", IntegerType())])
PEOPLE_1 = [("Alice", 10), ("Bob", 11), ("Charlie", 12)]
PEOPLE_2 = [("Daniel", 99), ("Alice", 1), ("Bob", 10), ("Mary Jane", 43)]
PEOPLE_3 = [("Daniel", 99), ("Alice", 12), ("Julie", 14), ("Mon", 54)]

# The three lines of the custom-sink example.
TEXT_LINES = ["This is an example of sink function", "some other string", "Daniel says this is ok"]
