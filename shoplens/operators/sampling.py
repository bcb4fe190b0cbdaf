"""Stratified, reproducible session sampling.

R1 turns the hourly session counts into per-hour quotas with integer
arithmetic. R2 draws exactly ``quota`` sessions per (date, hour), ordered
by a seeded hash of the session id (no ``rand()``, so reruns and task
retries pick the same sessions).

Skew: an hour may hold a large share of all sessions, so no hour is ever
sorted. A histogram of the hashes' first digits, per hour, says in which of
its ``16 ** PREFIX`` cells the quota is reached; a filter keeps the sessions
up to that cell, and only those, at most the quota and one cell, are ranked.
The draw needs ids and start times alone; whatever else a report shows is
attached to the drawn sessions afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.scalar import format_date
from shoplens.operators.joins import bounded_broadcast
from shoplens.operators.sessions import sessions_per_day

#: Hexadecimal digits of the histogram's cells (4,096 an hour).
PREFIX = 3


def extract_quota(hourly: DataFrame, total: int = 100) -> DataFrame:
    """Per (date, hour) quota = floor(hour_count * per_day / day_count), at most hour_count.

    ``per_day = total div number_of_days``.
    """
    d = sessions_per_day(hourly)
    d = d.withColumn("per_day", F.expr(f"{int(total)}L div num_days"))
    quota = F.least(F.expr("(hour_count * per_day) div day_count"), F.col("hour_count"))
    return d.select("date", "hour", "hour_count", "day_count", "num_days", "per_day", quota.alias("quota"))


def sample_order(seed: str) -> F.Column:
    """Reproducible draw order of a session: md5 of seed + id (then the id)."""
    return F.md5(F.concat(F.lit(seed), F.col("session_id")))


def hash_histogram(sessions: DataFrame, seed: str) -> DataFrame:
    """Sessions per (date, hour, first digits of the draw order)."""
    return (sessions.select(format_date("start_time").alias("date"), F.date_format("start_time", "HH").alias("hour"),
                            F.left(sample_order(seed), F.lit(PREFIX)).alias("prefix"))
            .groupBy("date", "hour", "prefix").agg(F.count(F.lit(1)).alias("held")))


def cut_offs(histogram: DataFrame, quotas: DataFrame) -> DataFrame:
    """(date, hour, quota, cut): the cell in which an hour reaches its quota."""
    so_far = F.sum("held").over(Window.partitionBy("date", "hour").orderBy("prefix"))
    wanted = quotas.select("date", "hour", "quota").filter(F.col("quota") > 0)
    cells = histogram.withColumn("so_far", so_far).join(wanted, ["date", "hour"])
    return (cells.filter(F.col("so_far") >= F.col("quota")).groupBy("date", "hour")
            .agg(F.max("quota").alias("quota"), F.min("prefix").alias("cut")))


def random_extract(sessions: DataFrame, quotas: DataFrame, seed: str = "shoplens",
                   histogram: DataFrame | None = None) -> DataFrame:
    """R2: ``quota`` sessions per (date, hour) of their start, drawn by seeded hash.

    An hour with fewer sessions than its quota gives none (R1 never asks for more).
    """
    histogram = hash_histogram(sessions, seed) if histogram is None else histogram
    # One row per (date, hour): at most 24 a day, so it is broadcast and the
    # sessions are filtered where they are.
    cuts = bounded_broadcast(cut_offs(histogram, quotas))
    s = (sessions.withColumn("date", format_date("start_time")).withColumn("hour", F.date_format("start_time", "HH"))
         .withColumn("_h", sample_order(seed)).join(cuts, ["date", "hour"])
         .filter(F.left("_h", F.lit(PREFIX)) <= F.col("cut")))
    order = Window.partitionBy("date", "hour").orderBy("_h", "session_id")
    return (s.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= F.col("quota"))
            .drop("_rn", "_h", "quota", "cut"))


def sample_sessions(sessions: DataFrame, total: int = 100, seed: str = "shoplens") -> DataFrame:
    """D13 -> R1 -> R2; the hourly counts are sums of the histogram."""
    histogram = hash_histogram(sessions, seed)
    hourly = histogram.groupBy("date", "hour").agg(F.sum("held").alias("hour_count"))
    return random_extract(sessions, extract_quota(hourly, total), seed, histogram)
