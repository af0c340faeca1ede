"""Batch queries over the driver tables, each with its DuckDB oracle.

Parameters are hour-scale because the driver's events are minutes apart;
the reference's second-scale parameters are used on the golden fixtures
in ``tests/``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventflow import schemas as S
from eventflow.operators import joins, routing, running, transforms, windows
from eventflow.operators.aggregate import CountIf
from eventflow.plans.registry import query
from eventflow.plans.sqlviews import CART, CATALOG, HOUR, MIN, RULES, SERVER, ts_of, wstart
from eventflow.sinks.bus import encode_person
from eventflow.sources.bus import decode_person
from eventflow.sources.tables import read_table
from eventflow.sources.views import adds_and_rules, cart_and_catalog, cart_events, catalog_events, server_events


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


def _cart(spark, sf):
    return cart_events(_events(spark, sf))


def _server(spark, sf):
    return server_events(_events(spark, sf))


def _catalog(spark, sf):
    return catalog_events(_events(spark, sf))


def REG():
    return F.col("event_type") == S.REGISTERED


def ADD():
    return F.col("event_type") == S.ADD


REG_SQL = "event_type = 'PlayerRegistered'"
ADD_SQL = "event_type = 'AddToShoppingCartEvent'"


# ---------------------------------------------------------------- windows

def _tumbling_sql(view: str, size_us: int, agg: str, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    return f"""SELECT {k}{ts_of('ws')} AS window_start, {ts_of(f'ws + {size_us}')} AS window_end, {agg} AS n
FROM (SELECT *, {wstart('epoch_us(ts)', size_us)} AS ws FROM {view}) GROUP BY {k}ws"""


@query("tumbling_registrations", _tumbling_sql(SERVER, HOUR, f"count(*) FILTER (WHERE {REG_SQL})"))
def tumbling_registrations(spark, sf):
    """Registrations per 1-hour window over all server events (0 kept)."""
    return windows.tumbling_count(_server(spark, sf), "1 hour", REG())


@query("tumbling_total", _tumbling_sql(CART, 3 * HOUR, "count(*)"))
def tumbling_total(spark, sf):
    """Cart events per 3-hour window."""
    return windows.tumbling_count(_cart(spark, sf), "3 hours")


@query("tumbling_by_type", _tumbling_sql(SERVER, HOUR, "count(*)", "event_type"))
def tumbling_by_type(spark, sf):
    """Server events per (type, 1-hour window)."""
    return windows.tumbling_count(_server(spark, sf), "1 hour", keys=["event_type"])


def _sliding_sql(view: str, size_us: int, slide_us: int, agg: str, where: str = "") -> str:
    k = size_us // slide_us
    w = f"WHERE {where}" if where else ""
    return f"""SELECT {ts_of('s')} AS window_start, {ts_of(f's + {size_us}')} AS window_end, {agg} AS n
FROM (SELECT v.*, {wstart('epoch_us(v.ts)', slide_us)} - r.i * {slide_us} AS s
      FROM (SELECT * FROM {view} {w}) v, range(0, {k}) r(i))
WHERE epoch_us(ts) < s + {size_us}
GROUP BY s"""


@query("sliding_registrations", _sliding_sql(SERVER, 3 * HOUR, HOUR, f"count(*) FILTER (WHERE {REG_SQL})"))
def sliding_registrations(spark, sf):
    """Registrations per sliding window, size 3 h, slide 1 h."""
    return windows.sliding_count(_server(spark, sf), "3 hours", "1 hour", REG())


@query("busiest_window", "SELECT * FROM (" + _sliding_sql(SERVER, 2 * HOUR, HOUR, "count(*)", REG_SQL)
       + ") ORDER BY n DESC, window_start LIMIT 1")
def busiest_window(spark, sf):
    """The 2 h / 1 h sliding window with most registrations (earliest on ties)."""
    return windows.busiest_window(_server(spark, sf), "2 hours", "1 hour", REG())


def _session_sql(view: str, gap_us: int, agg: str, key: str | None = None) -> str:
    part = f"PARTITION BY {key} " if key else ""
    k = f"{key}, " if key else ""
    return f"""WITH s AS (
  SELECT *, lag(ts) OVER ({part}ORDER BY ts, event_id) AS prev FROM {view}),
g AS (
  SELECT *, sum(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > {gap_us} THEN 1 ELSE 0 END)
         OVER ({part}ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM s)
SELECT {k}min(ts) AS window_start, {ts_of(f'max(epoch_us(ts)) + {gap_us}')} AS window_end, {agg} AS n
FROM g GROUP BY {k}sid"""


@query("session_registrations", _session_sql(SERVER, 10 * MIN, f"count(*) FILTER (WHERE {REG_SQL})"))
def session_registrations(spark, sf):
    """Sessions (gap 10 min) over all server events, registrations counted."""
    return windows.session_count(_server(spark, sf), "10 minutes", predicate=REG())


@query("session_by_user", _session_sql(SERVER, 6 * HOUR, "count(*)", "player_id"))
def session_by_user(spark, sf):
    """W7 keyed: sessions per player (gap 6 h), events counted."""
    return windows.session_count(_server(spark, sf), "6 hours", keys=["player_id"])


@query("global_count_windows", f"""SELECT rn // 10 AS firing_no, c AS n FROM (
  SELECT row_number() OVER w AS rn, count(*) FILTER (WHERE {REG_SQL}) OVER w AS c
  FROM {SERVER} WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE rn % 10 = 0""")
def global_count_windows(spark, sf):
    """Global window firing every 10 server events; registrations so far."""
    return windows.count_windows(_server(spark, sf), 10, REG())


@query("global_count_windows_purging", f"""SELECT g AS firing_no, count(*) FILTER (WHERE reg) AS n FROM (
  SELECT (row_number() OVER (ORDER BY ts, event_id) - 1) // 10 + 1 AS g, {REG_SQL} AS reg FROM {SERVER})
GROUP BY g HAVING count(*) = 10""")
def global_count_windows_purging(spark, sf):
    """W8 purging: registrations among each block of 10 events."""
    return windows.count_windows(_server(spark, sf), 10, REG(), purge=True)


def _early_sql(size_us: int, every: int, purge: bool) -> str:
    val = f"CAST({every} AS BIGINT)" if purge else "rn"
    return f"""SELECT {ts_of('ws')} AS window_start, {ts_of(f'ws + {size_us}')} AS window_end,
       rn // {every} AS firing_no, {val} AS n
FROM (SELECT ws, row_number() OVER (PARTITION BY ws ORDER BY ts, event_id) AS rn
      FROM (SELECT *, {wstart('epoch_us(ts)', size_us)} AS ws FROM {CART}))
WHERE rn % {every} = 0"""


@query("early_count", _early_sql(HOUR, 5, False))
def early_count(spark, sf):
    """Count trigger (every 5) in 1-hour windows, accumulating."""
    return windows.early_count(_cart(spark, sf), "1 hour", 5)


@query("early_count_purging", _early_sql(HOUR, 5, True))
def early_count_purging(spark, sf):
    """Purging count trigger (every 5) in 1-hour windows."""
    return windows.early_count(_cart(spark, sf), "1 hour", 5, purge=True)


@query("registrations_agg_udaf", _tumbling_sql(SERVER, HOUR, f"count(*) FILTER (WHERE {REG_SQL})"))
def registrations_agg_udaf(spark, sf):
    """The W3 count as a user-defined incremental aggregate."""
    return windows.apply_per_window(_server(spark, sf), "1 hour",
                                    CountIf("event_type", S.REGISTERED, "n"))


# ---------------------------------------------------------------- keyed state (batch)

_W_USER = "PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@query("rolling_sum", f"""SELECT event_id, user_id,
  CAST(sum(quantity) OVER ({_W_USER}) AS BIGINT) AS running FROM {CART}""")
def rolling_sum(spark, sf):
    """A1: running sum of quantity per user after every cart event."""
    return running.rolling_reduce(_cart(spark, sf), "user_id", "quantity").select("event_id", "user_id", "running")


@query("final_sum", f"SELECT user_id, CAST(sum(quantity) AS BIGINT) AS total FROM {CART} GROUP BY user_id")
def final_sum(spark, sf):
    """A2: final quantity sum per user."""
    return running.final_reduce(_cart(spark, sf), "user_id", "quantity")


@query("running_count", f"SELECT event_id, user_id, row_number() OVER ({_W_USER}) AS n FROM {CART}")
def running_count(spark, sf):
    """A4: events so far per user."""
    return running.running_count(_cart(spark, sf)).select("event_id", "user_id", "n")


@query("running_type_counts", f"""SELECT event_id, user_id,
  CASE WHEN a > 0 THEN a END AS n_add, CASE WHEN r > 0 THEN r END AS n_removed
FROM (SELECT event_id, user_id,
        count(*) FILTER (WHERE event_type = 'AddToShoppingCartEvent') OVER w AS a,
        count(*) FILTER (WHERE event_type = 'RemovedFromShoppingCartEvent') OVER w AS r
      FROM {CART} WINDOW w AS ({_W_USER}))""")
def running_type_counts(spark, sf):
    """A5: the user's map of counts per event type after every event
    (compared as one column per type; absent types are null)."""
    r = running.running_type_counts(_cart(spark, sf))
    return r.select("event_id", "user_id",
                    F.col("counts")[S.ADD].alias("n_add"),
                    F.col("counts")[S.REMOVED].alias("n_removed"))


@query("running_list_size", f"SELECT event_id, user_id, row_number() OVER ({_W_USER}) AS n FROM {CART}")
def running_list_size(spark, sf):
    """Size of the user's (unbounded) event list after every event."""
    return running.running_list_size(_cart(spark, sf)).select("event_id", "user_id", "n")


@query("retained_count", f"""SELECT event_id, user_id,
  count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN {HOUR - 1} PRECEDING AND CURRENT ROW)
  - (count(*) OVER (PARTITION BY user_id, ts)
     - row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id)) AS n
FROM {CART}""")
def retained_count(spark, sf):
    """Events of the user younger than 1 hour after every event."""
    return running.retained_count(_cart(spark, sf), retention="1 hour").select("event_id", "user_id", "n")


@query("count_with_reset", f"SELECT event_id, user_id, row_number() OVER ({_W_USER}) % 11 AS n FROM {CART}")
def count_with_reset(spark, sf):
    """List cleared when its size exceeds 10."""
    return running.count_with_reset(_cart(spark, sf), limit=10).select("event_id", "user_id", "n")


@query("high_quantity_counts", f"""SELECT event_id, user_id, row_number() OVER ({_W_USER}) AS n
FROM {CART} WHERE {ADD_SQL} AND quantity > 5""")
def high_quantity_counts(spark, sf):
    """Per user, Add events with quantity > 5 so far (qualifying rows only)."""
    return running.high_quantity_counts(_cart(spark, sf), 5).select("event_id", "user_id", "n")


@query("running_share", f"""SELECT event_id,
  CAST(count(*) FILTER (WHERE side = 'left') OVER w AS DOUBLE) * 100.0 / CAST(count(*) OVER w AS DOUBLE) AS share
FROM (SELECT event_id, ts, 'left' AS side FROM {CART}
      UNION ALL SELECT event_id, ts, 'right' AS side FROM {CATALOG})
WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_share(spark, sf):
    """A10: running share of cart events among cart + catalog events."""
    return running.running_share_tagged(cart_and_catalog(_events(spark, sf))).select("event_id", "share")


# ---------------------------------------------------------------- projections

@query("classify", """SELECT event_id AS n,
  CASE WHEN event_id % 3 = 0 AND event_id % 5 = 0 THEN 'fizzbuzz'
       WHEN event_id % 3 = 0 THEN 'fizz'
       WHEN event_id % 5 = 0 THEN 'buzz'
       ELSE CAST(event_id AS VARCHAR) END AS output
FROM events""")
def classify(spark, sf):
    """Fizzbuzz over event ids."""
    return transforms.classify(_events(spark, sf), "event_id")


@query("expand_pair", "SELECT event_id, unnest([event_id, event_id + 1]) AS m FROM events")
def expand_pair(spark, sf):
    """P5: each event id to [id, id + 1]."""
    return transforms.expand_pair(_events(spark, sf).select("event_id"), "event_id")


@query("expand_range", f"""SELECT event_id, unnest(generate_series(1, CAST(quantity AS BIGINT) - 1)) AS m
FROM {CART} WHERE quantity > 1""")
def expand_range(spark, sf):
    """Each quantity q to 1 until q (exclusive)."""
    d = _cart(spark, sf).select("event_id", F.col("quantity").cast("long").alias("quantity"))
    return transforms.expand_range(d, "quantity").select("event_id", "m")


@query("explode_by_quantity", f"""SELECT event_id, unnest(repeat([sku], quantity)) AS item
FROM {CART} WHERE {ADD_SQL} AND quantity > 0""")
def explode_by_quantity(spark, sf):
    """One row per purchased item."""
    adds = _cart(spark, sf).filter(ADD())
    return transforms.explode_by_quantity(adds).select("event_id", "item")


@query("only_subtype", f"SELECT event_id, user_id, sku, quantity, ts FROM {CART} WHERE {ADD_SQL}")
def only_subtype(spark, sf):
    """The Add subtype of the cart stream, with its columns."""
    return transforms.only(_cart(spark, sf), S.ADD)


@query("entity_ids", f"SELECT event_id, 'player|' || player_id || '|' || nickname AS entity_id FROM {SERVER}")
def entity_ids(spark, sf):
    """P10: derived entity ids of server events."""
    return transforms.server_entity_ids(_server(spark, sf)).select("event_id", "entity_id")


@query("warn_messages", f"""SELECT event_id,
  'large order: ' || CAST(quantity AS VARCHAR) || ' of ' || sku || ' by user '
  || CAST(user_id AS VARCHAR) || ' (limit 2)' AS message
FROM {CART} WHERE {ADD_SQL} AND quantity > 2""")
def warn_messages(spark, sf):
    """Text message built from row fields (J5 warnings)."""
    return joins.fixed_threshold(_cart(spark, sf), 2).select("event_id", "message")


@query("lifecycle_map", "SELECT event_id, event_id * 10 AS x FROM events")
def lifecycle_map(spark, sf):
    """A function with per-task setup / teardown (x10)."""
    schema = StructType([StructField("event_id", LongType()), StructField("x", LongType())])

    def fn(batch, factor):
        return batch.assign(x=batch["event_id"] * factor)[["event_id", "x"]]

    return transforms.map_with_lifecycle(_events(spark, sf).select("event_id"), fn, schema,
                                         setup=lambda: 10, teardown=lambda _r: None)


# ---------------------------------------------------------------- joins

@query("fixed_threshold", f"""SELECT event_id, user_id, quantity, 2 AS threshold
FROM {CART} WHERE {ADD_SQL} AND quantity > 2""")
def fixed_threshold(spark, sf):
    """Add events above a fixed threshold of 2."""
    return joins.fixed_threshold(_cart(spark, sf), 2, with_message=False).select(
        "event_id", "user_id", "quantity", "threshold")


@query("changing_threshold", f"""SELECT event_id, user_id, quantity, threshold FROM (
  SELECT c.event_id, c.user_id, c.quantity, coalesce(r.value, 0) AS threshold
  FROM (SELECT * FROM {CART} WHERE {ADD_SQL}) c
  ASOF LEFT JOIN {RULES} r ON c.ts >= r.effective_ts)
WHERE quantity > threshold""")
def changing_threshold(spark, sf):
    """Add events above the threshold in force at their time (rules are
    derived from error events; 0 before the first rule)."""
    got = joins.rule_as_of_tagged(adds_and_rules(_events(spark, sf)), ["event_id", "user_id", "quantity"])
    return got.filter(F.col("quantity") > F.col("threshold"))


def _right_catalog(spark, sf):
    return _catalog(spark, sf).select(F.col("event_id").alias("right_id"),
                                      F.col("user_id").alias("r_user_id"),
                                      F.col("ts").alias("right_ts"))


@query("window_join", f"""SELECT {ts_of('l.ws')} AS window_start, {ts_of(f'l.ws + {6 * HOUR}')} AS window_end,
  l.user_id, l.event_id AS left_id, r.event_id AS right_id
FROM (SELECT *, {wstart('epoch_us(ts)', 6 * HOUR)} AS ws FROM {CART} WHERE {ADD_SQL}) l
JOIN (SELECT *, {wstart('epoch_us(ts)', 6 * HOUR)} AS ws FROM {CATALOG}) r
  ON l.user_id = r.user_id AND l.ws = r.ws""")
def window_join(spark, sf):
    """Purchases and product views of one user in the same 6-hour window."""
    left = _cart(spark, sf).filter(ADD()).select(F.col("event_id").alias("left_id"), "user_id", "ts")
    j = joins.window_join(left, _right_catalog(spark, sf), [("user_id", "r_user_id")], "6 hours",
                          left_ts="ts", right_ts="right_ts")
    return j.select("window_start", "window_end", "user_id", "left_id", "right_id")


@query("interval_join", f"""SELECT l.user_id, l.event_id AS left_id, r.event_id AS right_id,
  l.ts AS left_ts, r.ts AS right_ts
FROM (SELECT * FROM {CART} WHERE {ADD_SQL}) l JOIN {CATALOG} r
  ON l.user_id = r.user_id AND r.ts > l.ts - INTERVAL 2 HOUR AND r.ts < l.ts + INTERVAL 2 HOUR""")
def interval_join(spark, sf):
    """Product views within (-2 h, 2 h) of a purchase, bounds exclusive."""
    left = _cart(spark, sf).filter(ADD()).select(F.col("event_id").alias("left_id"), "user_id",
                                               F.col("ts").alias("left_ts"))
    j = joins.interval_join(left, _right_catalog(spark, sf), [("user_id", "r_user_id")],
                            "-2 hours", "2 hours", left_ts="left_ts", right_ts="right_ts",
                            lower_inclusive=False, upper_inclusive=False)
    return j.select("user_id", "left_id", "right_id", "left_ts", "right_ts")


@query("union_sources", f"""SELECT event_id, user_id, ts, 'cart' AS source_id FROM {CART}
UNION ALL SELECT event_id, user_id, ts, 'catalog' AS source_id FROM {CATALOG}""")
def union_sources(spark, sf):
    """Bag union of two event streams with a source marker."""
    cols = ["event_id", "user_id", "ts"]
    return joins.union_sources([_cart(spark, sf).select(*cols), _catalog(spark, sf).select(*cols)],
                               ["cart", "catalog"])


@query("connected", f"""SELECT event_id, 'left' AS side, user_id, sku, CAST(NULL AS VARCHAR) AS product_id FROM {CART}
UNION ALL SELECT event_id, 'right' AS side, user_id, CAST(NULL AS VARCHAR) AS sku, product_id FROM {CATALOG}""")
def connected(spark, sf):
    """Cart and catalog streams connected into one tagged stream."""
    c = joins.connect(_cart(spark, sf).select("event_id", "user_id", "sku"),
                      _catalog(spark, sf).select("event_id", "user_id", "product_id"))
    return c.select("event_id", "side", "user_id", "sku", "product_id")


@query("connected_state", f"""SELECT event_id, user_id, side,
  CAST(count(*) FILTER (WHERE side = 'left') OVER w AS DOUBLE) * 100.0 / CAST(count(*) OVER w AS DOUBLE) AS share
FROM (SELECT event_id, user_id, ts, 'left' AS side FROM {CART}
      UNION ALL SELECT event_id, user_id, ts, 'right' AS side FROM {CATALOG})
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def connected_state(spark, sf):
    """J4 keyed: each user's share of cart events among cart and catalog events so far, after every event of either."""
    return joins.connected_share_tagged(cart_and_catalog(_events(spark, sf)), "user_id").select("event_id", "user_id", "side", "share")


# ---------------------------------------------------------------- routing

@query("side_output", f"""SELECT CASE WHEN user_id = 1 THEN 'side' ELSE 'main' END AS route, count(*) AS n
FROM {CART} GROUP BY 1""")
def side_output(spark, sf):
    """One user's events to a side output, the rest to main; rows per route."""
    return routing.route(_cart(spark, sf), F.col("user_id") == 1).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query("hash_partition_colocation", f"SELECT user_id, CAST(1 AS BIGINT) AS n_partitions FROM {CART} GROUP BY user_id")
def hash_partition_colocation(spark, sf):
    """After the custom hash partitioner each user lives in one partition."""
    p = routing.partition_by_hash(_cart(spark, sf), "user_id", 8)
    return (p.withColumn("pid", F.spark_partition_id())
             .groupBy("user_id").agg(F.countDistinct("pid").alias("n_partitions")))


@query("concentrated", f"SELECT 7 AS partition_id, count(*) AS n_rows FROM {CART}")
def concentrated(spark, sf):
    """R2: every row sent to the last of 8 partitions."""
    p = routing.concentrate(_cart(spark, sf), 8)
    return (p.withColumn("partition_id", F.spark_partition_id())
             .groupBy("partition_id").agg(F.count(F.lit(1)).alias("n_rows")))


@query("rebalanced", f"SELECT count(*) AS n_rows, CAST(8 AS BIGINT) AS n_partitions FROM {CART}")
def rebalanced(spark, sf):
    """Round-robin redistribution into 8 partitions; no row lost."""
    p = routing.rebalance(_cart(spark, sf), 8)
    return (p.withColumn("pid", F.spark_partition_id())
             .agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("pid").alias("n_partitions")))


# ---------------------------------------------------------------- codecs

@query("person_codec_roundtrip", """SELECT 'u' || CAST(user_id AS VARCHAR) AS name,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS age FROM events""")
def person_codec_roundtrip(spark, sf):
    """S4 + K4: people encoded to bus records and decoded back."""
    people = _events(spark, sf).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("name"),
        F.get_json_object("props", "$.k").cast("int").alias("age"))
    return decode_person(encode_person(people, "people"), mode="failfast")
