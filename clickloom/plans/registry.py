"""The list of registered queries; each one is a Spark callable with an optional SQL statement to check it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

# The behaviour-event view in SQL.
EVENTS_SQL = """
ev AS (
  SELECT event_id, ts, epoch_us(ts) // 1000 AS ts_ms, CAST(user_id AS VARCHAR) AS user_id, event_type,
         json_extract_string(props, '$.k') AS product_id, value AS price,
         p_type AS category_code, p_brand AS brand, p_name AS product_name
  FROM events LEFT JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT)
)
"""


def query(name: str, check: str | None = None, events: bool = True) -> Callable[[Query], Query]:
    """Register a query; ``check`` may use the view ``ev`` unless ``events`` is off."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = function
        if check is not None:
            text = check.strip()
            if events:
                head = "WITH RECURSIVE" if text.upper().startswith("WITH RECURSIVE") else "WITH"
                if text.upper().startswith("WITH"):
                    text = f"{head} {EVENTS_SQL.strip()}, {text[len(head):].strip()}"
                else:
                    text = f"WITH {EVENTS_SQL.strip()} {text}"
            CHECKS[name] = text
        return function

    return register
