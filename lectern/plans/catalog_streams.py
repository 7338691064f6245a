"""Queries of incremental and windowed operators over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.plans.catalog import query
from lectern.session import table
from lectern.sources import tables
from lectern.streaming import ingest, windows


@query("windows_tumbling", "SELECT time_bucket(INTERVAL 1 hour, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def windows_tumbling(spark, sf_dir):
    """Extension: tumbling windows."""
    return windows.tumbling(table(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))


@query("windows_sessions", """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 minutes AND ts - lag(ts) OVER w < INTERVAL 30 minutes THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT min(ts) AS start, user_id, count(*) AS n FROM s GROUP BY user_id, k""")
def windows_sessions(spark, sf_dir):
    """Extension: session windows."""
    return windows.sessions(table(spark, sf_dir, "events"))


@query("ingest_new_batches", "SELECT event_id, date_trunc('day', ts) AS batch FROM events WHERE date_trunc('day', ts) NOT IN (SELECT date_trunc('day', ts) FROM events WHERE user_id = 7)")
def ingest_new_batches(spark, sf_dir):
    """Rows of batches not yet taken."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.date_trunc("day", "ts").alias("batch"))
    return ingest.unseen(e, e.where("user_id = 7"), "batch").select("event_id", "batch")


@query("listing_table", """SELECT 'nt' AS canon, event_type AS iso, 'f' || user_id % 3 AS folder, 'B' || user_id % 9 AS book, event_id % 40 AS chapter, 'FS' || user_id AS fileset FROM events""")
def listing_table(spark, sf_dir):
    """An object listing as a table."""
    u = F.col("user_id")
    name = F.concat(F.lit("B"), u % 9, F.lit("_"), F.lpad((F.col("event_id") % 40).cast("string"), 3, "0"), F.lit("_FS"), u, F.lit("_timing.json"))
    path = F.concat_ws("/", F.lit("nt"), "event_type", F.concat(F.lit("f"), u % 3), F.concat(F.lit("B"), u % 9), name)
    return tables.listing(table(spark, sf_dir, "events").select(path.alias("path")))
