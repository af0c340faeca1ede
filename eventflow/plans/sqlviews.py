"""DuckDB SQL text of the typed views (the oracle side of S7)."""

# The same event class names as eventflow.schemas.
CART = """(SELECT event_id,
       CASE event_type WHEN 'purchase' THEN 'AddToShoppingCartEvent'
                       ELSE 'RemovedFromShoppingCartEvent' END AS event_type,
       user_id,
       'sku-' || CAST(event_id AS VARCHAR) AS sku,
       CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS quantity,
       ts
  FROM events WHERE event_type IN ('purchase', 'click'))"""

CATALOG = """(SELECT event_id, user_id, 'p-' || CAST(event_id AS VARCHAR) AS product_id, ts
  FROM events WHERE event_type = 'view')"""

SERVER = """(SELECT event_id,
       CASE event_type WHEN 'signup' THEN 'PlayerRegistered'
                       WHEN 'view' THEN 'PlayerOnline'
                       ELSE 'PlayerOffline' END AS event_type,
       ts,
       CAST(user_id AS VARCHAR) AS player_id,
       'u' || CAST(user_id AS VARCHAR) AS nickname
  FROM events WHERE event_type IN ('signup', 'view', 'error'))"""

RULES = """(SELECT 'quantity-threshold' AS rule_name, ts AS effective_ts,
       CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS value,
       event_id AS rule_id
  FROM events WHERE event_type = 'error')"""

US = 1
SEC = 1_000_000
MIN = 60 * SEC
HOUR = 60 * MIN
DAY = 24 * HOUR


def wstart(us_expr: str, size_us: int) -> str:
    return f"({us_expr} - ({us_expr} % {size_us}))"


def ts_of(us_expr: str) -> str:
    return f"make_timestamp(CAST({us_expr} AS BIGINT))"
