"""Statements for the final state of the streams."""

from __future__ import annotations

from .. import catalog
from ..sources import bindings as b
from .review_sql import on_texts
from .sql import with_ctes

STATUS = " ".join(f"WHEN '{e}' THEN '{s}'" for e, s in b.STATUS_BY_EVENT.items())
EVENTS = f"""keyed AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events
), good AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts, CAST(user_id * 10 + k % 10 AS VARCHAR) AS order_id,
    CAST(user_id AS VARCHAR) AS seller_id, CASE event_type {STATUS} END AS status, event_id AS version,
    TIMESTAMP '2024-01-03' + to_days(CAST((user_id * 10 + k % 10) % 25 AS INT)) AS due,
    CAST(value AS DECIMAL(12,2)) AS amount, k
  FROM keyed WHERE k <> 99
), days AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, seller_id, COUNT(*) AS events,
    COUNT(*) FILTER (WHERE status = 'delivered') AS sales,
    CAST(COALESCE(SUM(amount) FILTER (WHERE status = 'delivered'), 0) AS DOUBLE) AS amount
  FROM good GROUP BY 1, 2
)"""


def statements() -> dict[str, str]:
    head = with_ctes(EVENTS)
    return {
        "latest_status": head
        + """SELECT order_id, status, version, ts AS event_time, seller_id, due AS estimated_delivery_date
        FROM good QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY version DESC) = 1""",
        "seller_daily": head + "SELECT * FROM days",
        "late_events": head
        + f"""SELECT event_id, ts AS event_time, order_id, status FROM good g JOIN (
          SELECT p AS arrival, date_trunc('millisecond', max(ts)) - INTERVAL 2 DAY AS mark
          FROM good, range({catalog.ARRIVALS}) AS a(p) WHERE version % {catalog.ARRIVALS} < p GROUP BY p
        ) ON version % {catalog.ARRIVALS} = arrival WHERE ts <= mark""",
        "monthly_curve": head
        + """SELECT seller_id, substr(day, 1, 7) AS month, CAST(SUM(sales) AS BIGINT) AS sales,
        CAST(SUM(CAST(amount AS DECIMAL(24,4))) AS DOUBLE) AS amount FROM days
        WHERE CAST(day AS DATE) >= (SELECT date_trunc('month', max(CAST(day AS DATE))) - INTERVAL 5 MONTH FROM days)
        GROUP BY 1, 2""",
        "late_alerts": head
        + """SELECT order_id, any_value(seller_id) AS seller_id, any_value(due) AS due FROM good GROUP BY 1
        HAVING any_value(due) < (SELECT max(ts) FROM good)
          AND COUNT(*) FILTER (WHERE status IN ('delivered', 'canceled')) = 0""",
        "dead_letters": head
        + """SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_time, substr(props, 1, 5) AS payload,
        (SELECT CAST(SUM(CASE WHEN k < 10 THEN 2 ELSE 1 END) AS BIGINT) FROM good) AS readable_events
        FROM keyed WHERE k = 99""",
        "stream_reviews": on_texts(
            """SELECT dedup_key, review_id, route, needs_manual_review, tok AS tokens FROM texts
            WHERE raw_text <> ''"""
        ),
    }
