"""Window queries over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.plans.registry import Registry
from marketlens.streaming.windows import session_counts, tumbling_counts

R = Registry()


@R.query("streaming", "SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') AS start, event_type AS kind, count(*) AS n FROM events GROUP BY 1, 2")
def tumbling_events(t):  # noqa: ANN001, ANN202
    return tumbling_counts(t("events"), "ts", "event_type", "6 hours").withColumn("start", F.col("start").cast("timestamp_ntz"))


@R.query("streaming W11", """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, s.s""")  # fmt: skip
def session_events(t):  # noqa: ANN001, ANN202
    return session_counts(t("events"), "ts", "user_id", "30 minutes").withColumn("start", F.col("start").cast("timestamp_ntz"))
