"""Real-time ad-click statistics with a self-updating blacklist.

Three checkpointed Structured Streaming queries, each with its state in
Spark's state store and its progress in its checkpoint:

``filter``  ad log -> clicks. A user's state (listed or not, clicks per
            (date, ad)) decides what becomes of the user's clicks of a
            batch: of a listed user they are dropped; else they are kept and
            counted, and when a (date, ad) total reaches the threshold the
            user is listed from the next batch on (A11, S2, S3, S4). Users
            are hashed to ``PARTS`` parts that hold their states together:
            a call of the state function costs milliseconds, whatever it
            holds. Lines are counted per task before the shuffle, so a user
            with a third of all clicks is a few rows a task. The file sink
            writes kept clicks, dropped counts, newly listed users and
            malformed lines exactly once, by kind.
``totals``  kept clicks -> running totals per (date, user, ad), per (date,
            province, city, ad) and per (date, province, ad): one streaming
            aggregation in update mode (S3, S5; M1). Its rows are the new
            totals of the touched keys; ``foreachBatch`` merges them into
            plain tables (M2) and the touched provinces' top 3 (S6, M3). What
            the merge left of the touched ``ad_stat`` keys is kept batch by
            batch, under the ``filter`` batch that touched them last.
``trend``   kept clicks -> clicks per (minute window, ad) under a watermark:
            windows that are older than the watermark are settled and leave
            the state, clicks that come later than that are not counted (S7).

The result tables are plain Parquet, partitioned by date. A batch reads and
rewrites only the days that it touches (``rewrite_days``): the new days are
written aside in full before the first old file goes, so a batch that failed
anywhere and is replayed ends in the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from shoplens import schemas
from shoplens.config import release
from shoplens.operators import ads
from shoplens.operators.joins import shuffled
from shoplens.operators.merge import merge_overwrite, replace_groups
from shoplens.operators.regions import top_n_per_group

# The reference job's batch interval and blacklist threshold.
BATCH_INTERVAL = "5 seconds"
BLACKLIST_THRESHOLD = 100
#: How long after the newest click an earlier minute still takes clicks.
TREND_DELAY = "10 minutes"

#: Rows of the ``filter`` query; ``n`` clicks (or lines) each.
CLICKS = ("batch_id long, user_id long, date string, hour string, minute string, province string, city string, "
          "ad_id long, event_time timestamp, value string, n long, kind string")
#: Their pandas types: nullable, as a long that met a missing one would become a float.
_PANDAS = {name: {"long": "Int64", "timestamp": "datetime64[ns]"}.get(kind, "object")
           for name, kind in (c.split() for c in CLICKS.split(", "))}
_KEYS = ["valid", "part", "seeded", "user_id", "date", "hour", "minute", "province", "city", "ad_id", "value"]
_COUNTED = ("valid boolean, part long, seeded boolean, user_id long, date string, hour string, minute string, "
            "province string, city string, ad_id long, value string, event_time timestamp, n long")
#: Of a part: its listed users, and the others' clicks per (user, date, ad).
_PART_STATE = "listed array<bigint>, users array<bigint>, dates array<string>, ads array<bigint>, counts array<bigint>"
#: Parts that users (and malformed lines, by their text) are hashed to; fixed for the life of a checkpoint.
PARTS = 1024


def ad_log_stream(spark: SparkSession, source: str, fmt: str = "text", **options) -> DataFrame:
    """The ad log as a streaming DataFrame with one ``value`` text column.

    ``fmt="kafka"`` reads a topic (``options`` are the Kafka source options,
    e.g. ``kafka.bootstrap.servers``, ``subscribe``, ``startingOffsets``;
    needs the Kafka connector jar); ``"text"`` reads new files under
    ``source`` (recursively). ``maxFilesPerTrigger`` (``maxOffsetsPerTrigger``)
    bounds what one batch takes.
    """
    if fmt == "kafka":
        reader = spark.readStream.format("kafka")
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(source)


# ---------------------------------------------------------------- filter

def counted_lines(lines: DataFrame, seeds: DataFrame | None) -> DataFrame:
    """Parsed lines (S1), equal clicks of a task's batch counted together.

    ``part`` is the part of a valid line's user, of a malformed line's text;
    ``seeded`` marks users that were on the blacklist before the stream.
    """
    parsed = ads.parse_ad_log(lines)
    shown = ads.ad_time_texts(parsed)
    valid, named = F.col("is_valid"), {}
    for c in ("user_id", "date", "hour", "minute", "province", "city", "ad_id"):
        named[c] = F.when(valid, F.col(c)).alias(c)
    part = F.pmod(F.when(valid, F.xxhash64("user_id")).otherwise(F.xxhash64("value")), F.lit(PARTS))
    rows = shown.select(valid.alias("valid"), part.alias("part"), *named.values(),
                        F.when(~valid, F.coalesce("value", F.lit(""))).alias("value"),
                        F.when(valid, F.timestamp_millis("time_ms")).alias("event_time"))
    if seeds is not None:
        known = seeds.select(F.col("user_id").cast("bigint").alias("user_id")).distinct().withColumn("seeded", F.lit(True))
        rows = rows.join(known, "user_id", "left").withColumn("seeded", F.coalesce("seeded", F.lit(False)))
    else:
        rows = rows.withColumn("seeded", F.lit(False))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = pa.Table.from_batches([batch]).group_by(_KEYS).aggregate([("event_time", "max"), ([], "count_all")])
                yield from found.select([*_KEYS, "event_time_max", "count_all"]).rename_columns(
                    [*_KEYS, "event_time", "n"]).to_batches()

    return rows.select(*_KEYS, "event_time").mapInArrow(count, _COUNTED)


def _judge(threshold: int) -> Callable:
    """The state function of a part of the users: what becomes of their clicks of a batch."""

    def rows(found: pd.DataFrame, batch_id: int, kind: str) -> pd.DataFrame:
        return found.assign(batch_id=batch_id, kind=kind).reindex(columns=list(_PANDAS)).astype(_PANDAS)

    def user_rows(batch_id: int, kind: str, counts: dict[int, int]) -> pd.DataFrame:
        return rows(pd.DataFrame({"user_id": list(counts), "n": list(counts.values())}), batch_id, kind)

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        valid, _ = key
        batch_id = int(TaskContext.get().getLocalProperty("streaming.sql.batchId"))
        if not valid:
            for f in frames:
                yield rows(f[["value", "n"]], batch_id, "malformed")
            return
        listed, *columns, counts = state.get if state.exists else ([],) * 5
        listed, total = set(listed), dict(zip(zip(*columns), counts))
        seen, dropped = set(), {}
        for f in frames:
            listed.update(f.loc[f["seeded"], "user_id"].tolist())
            out = f["user_id"].isin(listed)
            for user, n in zip(f.loc[out, "user_id"].tolist(), f.loc[out, "n"].tolist()):
                dropped[user] = dropped.get(user, 0) + n
            if out.all():
                continue
            kept = f[~out]
            yield rows(kept.drop(columns="value"), batch_id, "kept")
            for *k, n in zip(*(kept[c].tolist() for c in ("user_id", "date", "ad_id", "n"))):
                total[tuple(k)] = total.get(tuple(k), 0) + n
            seen.update(kept["user_id"].tolist())
        if dropped:
            yield user_rows(batch_id, "dropped", dropped)
        reached = {user for (user, _, _), n in total.items() if n >= threshold and user in seen}
        if reached:
            yield user_rows(batch_id, "listed", dict.fromkeys(reached, 0))
            listed |= reached
        rest = [(*k, n) for k, n in total.items() if k[0] not in listed]   # a listed user needs no counts any more
        state.update((list(listed), *([r[i] for r in rest] for i in range(4))))

    return judge


def judged_clicks(lines: DataFrame, threshold: int, seeds: DataFrame | None = None) -> DataFrame:
    """S2-S4 on a stream of ad log lines: rows of ``CLICKS``."""
    return counted_lines(lines, seeds).groupBy("valid", "part").applyInPandasWithState(
        _judge(threshold), CLICKS, _PART_STATE, "append", GroupStateTimeout.NoTimeout)


# ---------------------------------------------------------------- tables

def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A result table partitioned by date; empty before its first batch."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def rewrite_days(spark: SparkSession, path: str, schema: StructType, days: Sequence[str], batch_id: int,
                 merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Replace the given days of a table by ``merge`` (their rows); returns the new rows.

    The result is first written aside in full, under the batch's name. Only
    then the days are overwritten from there, so the batch can be repeated
    after a failure at any point: what is there in full is not computed
    again from days that may be half replaced.
    """
    aside = f"{path}_next/batch_id={batch_id}"
    if not _exists(spark, f"{aside}/_SUCCESS"):
        current = read_table(spark, path, schema).filter(F.col("date").isin(list(days)))
        merge(current).select(*schema.names).hint("rebalance", "date").write.mode("overwrite").parquet(aside)
    new = spark.read.schema(schema).parquet(aside)
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    release(spark, [f"{path}_next/batch_id={batch_id - 1}"])
    return new


def top_after(old: DataFrame, totals: DataFrame, n: int = 3) -> DataFrame:
    """The top ``n`` ads of every province in ``totals``, from the top ``n`` before and the touched ads' new totals.

    Totals only grow, so an ad that was not among the first and has no new
    total is not among them now: the few rows kept per province are enough,
    no other ad's total is read again.
    """
    keys = [*ads.PROVINCE_KEYS, "ad_id"]
    rest = (old.join(shuffled(totals.select(*ads.PROVINCE_KEYS).distinct()), list(ads.PROVINCE_KEYS), "left_semi")
            .join(shuffled(totals.select(*keys)), keys, "left_anti"))
    return top_n_per_group(rest.select(*totals.columns).unionByName(totals), ads.PROVINCE_KEYS,
                           [F.col("click_count").desc(), F.col("ad_id")], n)


def _run_all(jobs: Sequence[Callable[[], object]]) -> list:
    """Run independent Spark writes as concurrent jobs; re-raise the first failure."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(j) for j in jobs]]


@dataclass(frozen=True)
class AdStream:
    """The three queries over one folder, and readers of their tables."""

    base: str
    threshold: int = BLACKLIST_THRESHOLD
    delay: str = TREND_DELAY
    seeds: DataFrame | None = field(default=None, compare=False)

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def _start(self, writer, name: str, trigger: dict | None) -> StreamingQuery:
        return (writer.option("checkpointLocation", self.path(f"checkpoint_{name}"))
                .trigger(**(trigger or {"processingTime": BATCH_INTERVAL})).start())

    # -- the queries (S8: every one on the job's trigger) ---------------------

    def start_filter(self, lines: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        """Judge the lines' clicks."""
        judged = judged_clicks(lines, self.threshold, self.seeds)
        return self._start(judged.writeStream.format("parquet").outputMode("append").partitionBy("kind")
                           .option("path", self.path("clicks")), "filter", trigger)

    def _kept_stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.schema(CLICKS).parquet(self.path("clicks")).filter("kind = 'kept'")

    def start_totals(self, spark: SparkSession, trigger: dict | None = None) -> StreamingQuery:
        """Running totals in update mode, merged into the tables by day."""
        none = F.lit(None).cast("string")
        nobody = F.lit(None).cast("bigint").alias("user_id")
        tables = F.array(F.struct(F.lit("ad_stat").alias("table"), "province", "city", nobody),
                         F.struct(F.lit("province_ads").alias("table"), "province", none.alias("city"), nobody),
                         F.struct(F.lit("user_counts").alias("table"), none.alias("province"), none.alias("city"), "user_id"))
        keys = ["table", "date", "province", "city", "user_id", "ad_id"]
        totals = (self._kept_stream(spark).select("date", "ad_id", "n", "batch_id", F.inline(tables))
                  .groupBy(*keys).agg(F.sum("n").alias("click_count"), F.max("batch_id").alias("batch_id")))
        return self._start(totals.writeStream.outputMode("update").foreachBatch(self.merge_totals), "totals", trigger)

    def start_trend(self, spark: SparkSession, trigger: dict | None = None) -> StreamingQuery:
        """Clicks per (minute window, ad) under the watermark."""
        counts = click_trend_stream(self._kept_stream(spark), self.delay, "n")
        return self._start(counts.writeStream.outputMode("update").foreachBatch(self.merge_trend), "trend", trigger)

    # -- one batch's totals into the tables -----------------------------------

    def merge_totals(self, totals: DataFrame, batch_id: int) -> None:
        """M2 of the new totals of the touched keys; S6 / M3 of the touched provinces."""
        spark = totals.sparkSession
        totals = totals.persist()
        try:
            days = [r[0] for r in totals.select("date").distinct().collect()]      # the batch's time span
            stat = totals.filter(F.col("table") == "ad_stat").select(*schemas.AD_STAT_CHANGES.names)
            users = totals.filter(F.col("table") == "user_counts").select(*schemas.AD_USER_CLICK_COUNT.names)

            best = totals.filter(F.col("table") == "province_ads").select(*schemas.AD_PROVINCE_TOP3.names)
            touched = best.select(*ads.PROVINCE_KEYS).distinct()

            def merged(name: str, schema: StructType, merge: Callable[[DataFrame], DataFrame]) -> Callable[[], DataFrame]:
                return lambda: rewrite_days(spark, self.path(name), schema, days, batch_id, merge)

            top, stats, _ = _run_all([
                merged("province_top3", schemas.AD_PROVINCE_TOP3,
                       lambda old: replace_groups(old, top_after(old, best), ads.PROVINCE_KEYS)),
                merged("ad_stat", schemas.AD_STAT, lambda old: merge_overwrite(old, stat, ads.AD_STAT_KEYS)),
                merged("user_counts", schemas.AD_USER_CLICK_COUNT, lambda old: merge_overwrite(old, users, ads.DAILY_KEYS))])
            top_changes = (top.join(shuffled(touched), list(ads.PROVINCE_KEYS), "left_semi")
                           .withColumn("batch_id", F.lit(batch_id).cast("bigint")))
            stat_changes = stats.join(shuffled(stat.select(*ads.AD_STAT_KEYS, "batch_id")), list(ads.AD_STAT_KEYS))
            _run_all([
                lambda: top_changes.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_id").parquet(self.path("top3_changes")),
                lambda: stat_changes.select(*schemas.AD_STAT_CHANGES.names).write.mode("overwrite")
                .parquet(self.path(f"ad_stat_changes/totals_batch={batch_id}"))])
        finally:
            totals.unpersist()

    def merge_trend(self, counts: DataFrame, batch_id: int) -> None:
        """M2 of the touched windows."""
        spark = counts.sparkSession
        counts = counts.persist()
        try:
            days = [r[0] for r in counts.select("date").distinct().collect()]
            rewrite_days(spark, self.path("click_trend"), schemas.AD_CLICK_TREND, days, batch_id,
                         lambda current: merge_overwrite(current, counts, ads.TREND_KEYS))
        finally:
            counts.unpersist()

    # -- readers ----------------------------------------------------------------

    def clicks(self, spark: SparkSession, *kinds: str) -> DataFrame:
        """Rows of the ``filter`` query: kept, dropped, listed, malformed."""
        return spark.read.schema(CLICKS).parquet(self.path("clicks")).filter(F.col("kind").isin(*kinds))

    def batches(self, spark: SparkSession) -> DataFrame:
        """A7 / S2 tallies per batch: lines, malformed, valid and kept ones."""
        n = lambda *kinds: F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds), F.col("n"))), F.lit(0))
        return (self.clicks(spark, "kept", "dropped", "malformed").groupBy("batch_id")
                .agg(F.sum("n").alias("lines"), n("malformed").alias("malformed"), n("kept", "dropped").alias("valid"),
                     n("kept").alias("kept")))

    def kept_counts(self, spark: SparkSession, keys: Sequence[str]) -> DataFrame:
        """Kept clicks per batch and key."""
        return self.clicks(spark, "kept").groupBy("batch_id", *keys).agg(F.sum("n").alias("click_count"))

    def blacklist(self, spark: SparkSession) -> DataFrame:
        """Every listed user once."""
        listed = self.clicks(spark, "listed").select("user_id")
        if self.seeds is None:
            return listed
        return listed.unionByName(self.seeds.select(F.col("user_id").cast("bigint").alias("user_id")).distinct())

    def user_click_counts(self, spark: SparkSession) -> DataFrame:
        """Running clicks per (date, user, ad)."""
        return read_table(spark, self.path("user_counts"), schemas.AD_USER_CLICK_COUNT)

    def ad_stat(self, spark: SparkSession) -> DataFrame:
        """Running clicks per (date, province, city, ad)."""
        return read_table(spark, self.path("ad_stat"), schemas.AD_STAT)

    def ad_stat_changes(self, spark: SparkSession) -> DataFrame:
        """The running totals that each batch wrote over ``ad_stat``'s, its touched keys only.

        ``batch_id`` is the last ``filter`` batch with a click of the key; of
        ``filter`` batches that ``totals`` took as one, it wrote one total.
        """
        return read_table(spark, self.path("ad_stat_changes"), schemas.AD_STAT_CHANGES)

    def click_trend(self, spark: SparkSession) -> DataFrame:
        """Clicks per (date, hour, minute, ad), late ones left out."""
        return read_table(spark, self.path("click_trend"), schemas.AD_CLICK_TREND)

    def province_top3(self, spark: SparkSession) -> DataFrame:
        """The top 3 ads per (date, province)."""
        return read_table(spark, self.path("province_top3"), schemas.AD_PROVINCE_TOP3)


def click_trend_stream(events: DataFrame, delay: str = TREND_DELAY, weight: str | None = None) -> DataFrame:
    """S7 as a stateful streaming aggregate: clicks per (minute window, ad).

    ``events`` is a streaming DataFrame of clicks with ``event_time`` and the
    UTC texts date, hour and minute; a row counts ``weight`` clicks. The
    watermark bounds the state: a window that ended ``delay`` before the
    newest event time is settled and dropped, its late clicks are not
    counted. Use output mode ``update`` and a merge-overwrite sink (M2).
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (events.withWatermark("event_time", delay)
            .groupBy(F.window("event_time", "1 minute"), "date", "hour", "minute", "ad_id")
            .agg(n.alias("click_count")).select("date", "hour", "minute", "ad_id", "click_count"))


class Backlog(StreamingQueryListener):
    """Whether the queries keep up with their trigger, from Spark's progress events.

    ``batches`` holds (query name or id, batch, rows, seconds) of every batch
    with rows; ``late(interval)`` names those that took longer than the
    trigger's interval, which is when ``maxFilesPerTrigger`` (or more cores)
    is due.
    """

    def __init__(self) -> None:
        self.batches: list[tuple[str, int, int, float]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            self.batches.append((p.name or str(p.id), p.batchId, p.numInputRows, p.batchDuration / 1000))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def late(self, interval: float) -> list[tuple[str, int, int, float]]:
        return [b for b in self.batches if b[3] > interval]
