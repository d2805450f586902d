"""Batch forms of the streaming extensions, which SQL can check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.sources.evidence import table
from folioscope.streaming import events as E

from .base import query


@query("hourly_events", "SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS hour, event_type, count(*) AS events, CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ALL")
def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.hourly(table(spark, sf_dir, "events")).withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


@query("user_sessions", """
WITH g AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE, true) AS fresh FROM events),
s AS (SELECT user_id, ts, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS started, count(*) AS events FROM s GROUP BY user_id, n""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.sessions(table(spark, sf_dir, "events")).withColumn("started", F.date_format("started", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
