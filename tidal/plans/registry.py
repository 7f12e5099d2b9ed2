"""Registry of named queries: a Spark builder and (where exact) a DuckDB twin.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables; each SQL string runs on the same tables registered as views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def query(name: str, sql: str | None = None, headline: bool = False):
    """Register ``fn`` as query ``name`` with an optional exact SQL twin."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        if getattr(fn, "__name__", "") in ("fn", "<lambda>"):
            fn.__name__ = f"q_{name}"
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        if headline:
            HEADLINE.append(name)
        return fn
    return deco


# --- shared SQL fragments (DuckDB dialect) -----------------------------------

SHIPMENTS_CTE = """shipments AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         r_name AS region,
         p_type AS sku_category,
         l_quantity AS shipping_weight_kg,
         CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 3
                   WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 2 ELSE 1 END AS INTEGER)
           AS request_urgency,
         CASE l_returnflag WHEN 'A' THEN 'air' WHEN 'R' THEN 'express' ELSE 'ground' END
           AS shipping_method,
         CAST(p_size AS DOUBLE) AS avg_repair_cycle_days,
         l_discount * 100 AS failure_rate_pct,
         CAST(isodow(l_shipdate) - 1 AS INTEGER) AS day_of_week,
         CAST(month(l_shipdate) AS INTEGER) AS month,
         CAST(CASE WHEN month(l_shipdate) IN (3, 6, 9, 12)
                    AND day(l_shipdate) >= day(last_day(CAST(l_shipdate AS DATE))) - 2
                   THEN 1 ELSE 0 END AS INTEGER) AS is_quarter_end
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

NET_EVENTS_CTE = """net_events AS (
  SELECT event_id,
         CAST(ts AS TIMESTAMP) AS "timestamp",
         concat('10.0.0.', CAST(user_id % 254 + 1 AS VARCHAR)) AS source_ip,
         concat('192.168.', CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR), '.1')
           AS dest_ip,
         CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS port,
         value AS duration_ms,
         CAST(round(value * 100) AS BIGINT) AS bytes_transferred,
         CASE WHEN user_id % 20 = 0 THEN 'ICMP' WHEN user_id % 20 IN (1, 2) THEN 'UDP' ELSE 'TCP' END
           AS protocol,
         CASE WHEN event_type = 'error' AND value > 200 THEN 'critical'
              WHEN event_type = 'error' THEN 'error'
              WHEN event_type = 'purchase' THEN 'warning' ELSE 'info' END AS severity,
         concat(event_type, ' by user ', CAST(user_id AS VARCHAR), ' from 10.0.0.',
                CAST(user_id % 254 + 1 AS VARCHAR), ': completed in ',
                CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), 'ms, code ',
                CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR)) AS log_message,
         CAST(hour(ts) AS INTEGER) AS hour_of_day,
         CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
         event_type AS true_cluster
  FROM events
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)
