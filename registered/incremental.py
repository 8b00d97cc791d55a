"""Watermark extracts and resume state."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from registered.common import Registry, load
from tidemark.functions.stamps import stamp_column
from tidemark.operators.changes import latest_changes
from tidemark.operators.incremental import (
    extract_summary,
    highest_watermark,
    incremental_extract,
    resume_window,
)
from tidemark.sources.state import latest_state

R = Registry()


@R.add("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15' AND ts <= TIMESTAMP '2024-01-25'")
def incr_events(spark, sf_dir):
    return incremental_extract(load(spark, sf_dir, "events"), "ts", "2024-01-15", "2024-01-25")


@R.add(
    "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1997-06-30' "
    "AND o_orderdate <= TIMESTAMP '1998-06-30'"
)
def incr_orders(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    return incremental_extract(orders, "o_orderdate", "1997-06-30", "1998-06-30")


@R.add(
    "SELECT * FROM lineitem WHERE l_shipdate > TIMESTAMP '1997-06-29 22:00:00' "
    "AND l_shipdate <= TIMESTAMP '1998-06-30'"
)
def incr_lineitem(spark, sf_dir):
    """The lower bound carries an offset and is compared as the UTC instant it names."""
    lineitem = load(spark, sf_dir, "lineitem")
    return incremental_extract(lineitem, "l_shipdate", "1997-06-30T00:00:00+02:00", "1998-06-30")


@R.add("""
    SELECT 'events' AS table_name, count(*) AS n_rows, max(ts) AS max_watermark FROM events
    WHERE ts > TIMESTAMP '2024-01-15' AND ts <= TIMESTAMP '2024-01-25'
    UNION ALL SELECT 'orders', count(*), max(o_orderdate) FROM orders
    WHERE o_orderdate > TIMESTAMP '1997-06-30' AND o_orderdate <= TIMESTAMP '1998-06-30'
    UNION ALL SELECT 'lineitem', count(*), max(l_shipdate) FROM lineitem
    WHERE l_shipdate > TIMESTAMP '1997-06-30' AND l_shipdate <= TIMESTAMP '1998-06-30'
""")
def incr_summary(spark, sf_dir):
    ranges = [
        ("events", "ts", "2024-01-15", "2024-01-25"),
        ("orders", "o_orderdate", "1997-06-30", "1998-06-30"),
        ("lineitem", "l_shipdate", "1997-06-30", "1998-06-30"),
    ]
    return extract_summary(
        {t: (incremental_extract(load(spark, sf_dir, t), c, lo, hi), c) for t, c, lo, hi in ranges}
    )


@R.add("""
    SELECT * FROM events
    WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 DAY
""")
def incr_default_since(spark, sf_dir):
    """No state yet: the day before the upper bound, here the highest watermark."""
    events = load(spark, sf_dir, "events")
    window = resume_window(highest_watermark(events, "ts"))
    return incremental_extract(events, "ts", window.since, window.upper)


@R.add("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'")
def incr_resume(spark, sf_dir):
    """Two runs, the second starting from the state of the first, leave out and repeat nothing."""
    events = load(spark, sf_dir, "events")
    first = resume_window("2024-01-12T06:00:00", since="2024-01-05")
    second = resume_window("2024-01-20", saved=first.upper)
    return incremental_extract(events, "ts", *first).unionByName(
        incremental_extract(events, "ts", *second)
    )


@R.add("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'")
def incr_lookback(spark, sf_dir):
    """The second run reads two days again; repeats fold away by key."""
    events = load(spark, sf_dir, "events")
    first = resume_window("2024-01-12", since="2024-01-05")
    second = resume_window("2024-01-20", saved=first.upper, lookback=timedelta(days=2))
    both = incremental_extract(events, "ts", *first).withColumn("run", F.lit(1)).unionByName(
        incremental_extract(events, "ts", *second).withColumn("run", F.lit(2))
    )
    return latest_changes(both, ["event_id"], ["run"]).select(events.columns)


@R.add("""
    SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN ts END AS updated_at FROM events
    WHERE event_id % 5 <> 0 AND ts > TIMESTAMP '2024-01-15'
""")
def incr_null_watermarks(spark, sf_dir):
    """Rows without a watermark are never extracted; without an upper bound the rest is open-ended."""
    stamped = load(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("updated_at")
    )
    return incremental_extract(stamped, "updated_at", "2024-01-15")


@R.add("""
    SELECT connection, driver, set_id, since FROM (
        SELECT event_type AS connection,
               CASE user_id % 2 WHEN 0 THEN 'pgsql' ELSE 'mysql' END AS driver,
               strftime(ts, '%Y%m%d_%H%M%S') AS set_id, ts AS since,
               row_number() OVER (PARTITION BY event_type, user_id % 2 ORDER BY ts DESC) AS rn
        FROM events) WHERE rn = 1
""")
def state_latest(spark, sf_dir):
    """Every event as one saved state; the last one of each connection and driver counts."""
    states = load(spark, sf_dir, "events").select(
        F.col("event_type").alias("connection"),
        F.when(F.col("user_id") % 2 == 0, "pgsql").otherwise("mysql").alias("driver"),
        stamp_column(F.col("ts")).alias("set_id"),
        F.col("ts").alias("saved_utc"),
        F.col("ts").alias("since"),
    )
    return latest_state(states).select("connection", "driver", "set_id", "since")
