"""Queries: monitoring stream (O-01) and its batch twin."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tessera.plans.registry import query
from tessera.session import checkpoint_dir
from tessera.sources.tables import table
from tessera.streaming import monitor as O

_C = O.CLASSES

_MONITOR_SQL = """
WITH b AS (SELECT count(*) AS n, max(value) AS vmax, """ + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{c}') / count(*) AS b_{c}" for c in _C) + """,
    count(*) FILTER (WHERE event_type IS NULL OR event_type NOT IN """ + str(_C) + """) / count(*) AS b_other FROM events),
w AS (SELECT time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS window_start, ts, event_type, value FROM events),
a AS (SELECT window_start, window_start + INTERVAL '7 days' AS window_end, count(*) AS n,
             count(*) FILTER (WHERE value / (SELECT vmax FROM b) >= 0.5) / count(*) AS coverage,
             count(*) FILTER (WHERE event_type = 'error') / count(*) AS correction_rate, """ + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{c}') / count(*) AS share_{c}" for c in _C) + """,
             count(*) FILTER (WHERE event_type IS NULL OR event_type NOT IN """ + str(_C) + """) / count(*) AS share_other
      FROM w GROUP BY window_start)
SELECT a.*, (""" + " + ".join(f"abs(share_{c} - b_{c})" for c in (*_C, "other")) + """) / 2.0 AS mix_drift
FROM a, b"""

_DOUBLES = ["coverage", "correction_rate", "mix_drift"] + [f"share_{c}" for c in (*_C, "other")]


@query("o01_monitor_weekly", _MONITOR_SQL, doubles=_DOUBLES)
def o01_monitor_weekly(spark, d):
    """Batch twin of the monitoring stream: every 7-day window."""
    ev = table(spark, d, "events")
    return O.window_metrics(ev, O.fit_baseline(ev), watermark=None)


@query("o01_monitor_stream", _MONITOR_SQL, doubles=_DOUBLES)
def o01_monitor_stream(spark, d):
    """Structured Streaming run (watermark 1 day, append mode, available-now
    trigger) over the events files, and the windows it has not closed yet."""
    ev = table(spark, d, "events")
    base = O.fit_baseline(ev)
    closed = O.run_stream(spark, d, base, file_glob="events.parquet")
    return closed.unionByName(O.open_windows(ev, closed, base))


_BASELINE_DAYS = 10
_PERIOD_SQL = f"""
WITH cut AS (SELECT date_trunc('day', min(ts)) + INTERVAL {_BASELINE_DAYS} DAYS AS until FROM events),
b AS (SELECT max(value) AS vmax, """ + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{c}') / count(*) AS b_{c}" for c in _C) + """,
    count(*) FILTER (WHERE event_type IS NULL OR event_type NOT IN """ + str(_C) + """) / count(*) AS b_other
    FROM events, cut WHERE ts < until),
e AS (SELECT p.period, CASE p.period WHEN 'week' THEN date_trunc('week', ts) ELSE date_trunc('month', ts) END AS start, event_type, value
      FROM events, cut, (VALUES ('week'), ('month')) AS p(period) WHERE ts >= until),
a AS (SELECT period, CAST(start AS TIMESTAMP) AS start, count(*) AS n,
             count(*) FILTER (WHERE value / (SELECT vmax FROM b) >= 0.5) / count(*) AS coverage,
             count(*) FILTER (WHERE event_type = 'error') / count(*) AS correction_rate, """ + ", ".join(
    f"count(*) FILTER (WHERE event_type = '{c}') / count(*) AS share_{c}" for c in _C) + """,
             count(*) FILTER (WHERE event_type IS NULL OR event_type NOT IN """ + str(_C) + """) / count(*) AS share_other
      FROM e GROUP BY ALL)
SELECT a.*, (""" + " + ".join(f"abs(share_{c} - b_{c})" for c in (*_C, "other")) + """) / 2.0 AS mix_drift
FROM a, b"""


@query("o01_drift_from_earlier_period", _PERIOD_SQL, doubles=_DOUBLES)
def o01_drift_from_earlier_period(spark, d):
    """Weeks and months against a baseline of the first ten days, saved and read
    back: closed days come from the stream, days still open from a batch."""
    ev = table(spark, d, "events")
    home = os.path.join(checkpoint_dir(spark), f"drift-{uuid.uuid4().hex}")
    until = ev.agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz") + F.expr(f"INTERVAL {_BASELINE_DAYS} DAYS")).first()[0]
    O.store_baseline(ev, until, os.path.join(home, "baseline"))
    base = O.load_baseline(spark, os.path.join(home, "baseline"))
    closed = O.run_day_stream(spark, d, base, home, file_glob="events.parquet")
    still_open = O.day_counts(ev, base, watermark=None).join(closed.select("day"), "day", "left_anti")
    return O.period_drift(closed.unionByName(still_open), base)
