"""Streams over events that arrive in waves, against SQL over all of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from mentionmill.plans.registry import query
from mentionmill.plans.views import table
from mentionmill.streaming import events as S
from mentionmill.streaming.resume import counts_by_window

C = F.col
#: Events come in three waves of ten days; those with an id divisible by 50 come a wave late.
WAVE = "wave AS (SELECT event_id, ts, user_id, event_type, CASE WHEN day(ts) <= 10 THEN 1 WHEN day(ts) <= 20 THEN 2 ELSE 3 END + {} AS wave FROM events)"
LATE = "CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END"


def waves(spark, d, late=0):
    """The waves, and one with a row of no one long after, which closes what is open."""
    e = table(spark, d, "events").select("event_id", C("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    day = F.dayofmonth("ts")
    wave = F.when(day <= 10, 1).when(day <= 20, 2).otherwise(3) + late
    last = spark.range(1).select(F.lit(None).cast(e.schema["event_id"].dataType).alias("event_id"), F.lit("2030-01-01 00:00:00").cast("timestamp").alias("ts"), F.lit(None).cast(e.schema["user_id"].dataType).alias("user_id"), F.lit(None).cast("string").alias("event_type"))
    return [e.where(wave == k) for k in (1, 2, 3, 4)] + [last]


def plain(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@query(
    "S01_sessions",
    "WITH s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 4 HOUR THEN 0 ELSE 1 END AS fresh FROM events)) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS \"end\", count(*) AS n FROM s GROUP BY user_id, no",
)
def s01(spark, d):
    """A user's sessions: rows less than four hours apart."""
    told = S.replayed(spark, waves(spark, d), lambda e: S.sessions(e, "ts", "user_id", "4 hours", "1 hour"), "sessions")
    return told.where("user_id IS NOT NULL").select("user_id", plain("start").alias("start"), plain("end").alias("end"), "n")


@query(
    "S02_windows_and_late_rows",
    "WITH " + WAVE.format(LATE) + ", known AS (SELECT wave + 1 AS wave, max(max(ts)) OVER (ORDER BY wave) - INTERVAL 1 HOUR AS mark FROM wave GROUP BY wave), "
    "kept AS (SELECT w.*, time_bucket(INTERVAL 6 HOUR, ts) AS start FROM wave w LEFT JOIN known k ON k.wave = w.wave WHERE k.mark IS NULL OR time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR > mark) "
    "SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM kept GROUP BY ALL",
)
def s02(spark, d):
    """Counts by six hours and type; rows that come after their window was closed are left out."""
    late = F.when(C("event_id") % 50 == 0, 1).otherwise(0)
    told = S.replayed(spark, waves(spark, d, late), lambda e: counts_by_window(e, "ts", "event_type", "6 hours", "1 hour"), "windows")
    return told.where("event_type IS NOT NULL").select(plain("start").alias("start"), "event_type", "n")


@query("S03_first_seen", "SELECT event_id, user_id FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE before IS NULL OR ts - before > INTERVAL 8 HOUR")
def s03(spark, d):
    """Events of users who were not seen for eight hours, by state that forgets users after as long."""
    told = S.replayed(spark, waves(spark, d), lambda e: S.first_seen(e, "ts", "user_id", 8 * 3600, "1 hour", "event_id"), "first-seen")
    return told.where("user_id IS NOT NULL").select("event_id", "user_id")
