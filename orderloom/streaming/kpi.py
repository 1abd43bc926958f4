"""Revenue figures over a stream of order events."""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from orderloom.operators.sessions import sessions

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
LATE = "1 hour"


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return (
        spark.readStream.schema(EVENTS)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


def _timed(events: DataFrame, late: str) -> DataFrame:
    """Event time as the watermark column; late rows beyond it are dropped."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def revenue_kpi(
    events: DataFrame, window: str = "1 hour", event_type: str = "purchase", late: str = LATE
) -> DataFrame:
    """Revenue and events per tumbling window; works on a stream and on a table."""
    timed = _timed(events, late) if events.isStreaming else events
    return (
        timed.where(F.col("event_type") == event_type)
        .groupBy(F.window("ts", window).alias("w"))
        .agg(F.sum("value").alias("revenue"), F.count("*").alias("events"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "revenue",
            "events",
        )
    )


def visit_sessions(events: DataFrame, gap: str = "30 minutes", late: str = LATE) -> DataFrame:
    """Sessions per user, closed after a gap without events.

    On a table a user of any size is spread over ranges; on a stream the open sessions of
    a user are state.
    """
    if not events.isStreaming:
        sums = {"events": F.lit(1), "value": F.col("value")}
        return sessions(events, "user_id", "ts", gap, sums, ["event_id"])
    return (
        _timed(events, late)
        .groupBy("user_id", F.session_window("ts", gap).alias("s"))
        .agg(F.count("*").alias("events"), F.sum("value").alias("value"))
        .select(
            "user_id",
            F.col("s.start").cast("timestamp_ntz").alias("session_start"),
            F.col("s.end").cast("timestamp_ntz").alias("session_end"),
            "events",
            "value",
        )
    )


def write_windows(
    windows: DataFrame, path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Append closed windows to a Parquet folder; ``once`` takes what is there and stops."""
    writer = (
        windows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(availableNow=True).start() if once else writer.start()


def write_late_counts(
    events: DataFrame,
    path: str,
    checkpoint: str,
    window: str = "1 hour",
    event_type: str = "purchase",
    late: str = LATE,
    once: bool = True,
) -> StreamingQuery:
    """Count, per micro-batch, the raw rows that ``revenue_kpi`` drops as late.

    A row is late when its window has ended by the watermark, which is the greatest time
    of the batches before, less ``late``.  Each batch writes one row to its own folder:
    its late rows, and the greatest time and all late rows so far, from the row of the
    batch before.  So a batch reads one row, however many there were, and a batch that is
    repeated writes the same row again.
    """

    def count(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mark = _late_state(spark, path, number - 1).select(
            F.col("max_ts").alias("_before"),
            F.col("all_late").alias("_all"),
            (F.col("max_ts") - F.expr(f"INTERVAL {late}")).alias("_mark"),
        )
        ends = F.window(F.col("ts"), window)["end"]
        dropped = (F.col("event_type") == event_type) & (ends <= F.col("_mark"))
        found = batch.crossJoin(F.broadcast(mark)).agg(
            F.max("ts").alias("_max"), F.count_if(dropped).alias("late")
        )
        row = found.crossJoin(F.broadcast(mark)).select(
            F.lit(number).cast("long").alias("batch"),
            F.greatest("_max", "_before").alias("max_ts"),
            "late",
            (F.col("_all") + F.col("late")).alias("all_late"),
        )
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/rows-{number}")

    writer = events.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()


_LATE_ROW = "batch long, max_ts timestamp_ntz, late long, all_late long"


def _late_state(spark: SparkSession, path: str, number: int) -> DataFrame:
    """The row of one batch; before the first, one that says nothing was seen."""
    if number < 0:
        return spark.createDataFrame([(-1, None, 0, 0)], _LATE_ROW)
    return spark.read.schema(_LATE_ROW).parquet(f"{path}/rows-{number}")


def late_rows(spark: SparkSession, path: str) -> int:
    """All rows dropped as late since ``write_late_counts`` began to count in ``path``."""
    rows = spark.read.schema(_LATE_ROW).parquet(f"{path}/rows-*")
    return rows.agg(F.coalesce(F.max("all_late"), F.lit(0))).first()[0]


def daily_alerts(closed_days: DataFrame, days: int = 28, width: float = 2.0) -> DataFrame:
    """Days whose revenue leaves the band of the ``days`` days before.

    ``closed_days`` has one row per day (window_start, revenue) of the whole history that
    counts.  Days without a row have revenue 0, and a day with fewer than ``days`` days
    before it raises nothing.  The window runs over one row per calendar day.
    """
    daily = closed_days.select(F.to_date("window_start").alias("day"), "revenue")
    span = daily.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    calendar = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    filled = calendar.join(daily, "day", "left").fillna(0.0, ["revenue"])
    before = Window.orderBy("day").rowsBetween(-days, -1)
    scored = filled.select(
        F.col("day").cast("timestamp_ntz").alias("window_start"),
        "revenue",
        F.avg("revenue").over(before).alias("mean_before"),
        F.stddev_samp("revenue").over(before).alias("std_before"),
        F.count("*").over(before).alias("_days"),
    )
    gap = F.abs(F.col("revenue") - F.col("mean_before"))
    far = gap > width * F.col("std_before")
    return scored.where((F.col("_days") == days) & far).drop("_days")


ALERT = "series string, window_start timestamp_ntz, revenue double, mean_before double, std_before double"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _LastDays(StatefulProcessor):
    """State of a series: its last day and the revenue of the ``days`` days up to it."""

    def __init__(self, days: int, width: float):
        self.days, self.width = days, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("days", "last date, revenue array<double>")

    def handleInputRows(self, key, rows, timerValues):
        fresh = pd.concat(list(rows)).sort_values("window_start")
        last, before = self.kept.get() if self.kept.exists() else (None, [])
        before, found = list(before), []
        for start, revenue in zip(fresh["window_start"], fresh["revenue"]):
            day = start.date()
            gap = (day - last).days if last is not None else 1
            # days that closed without a row had no revenue; older than the state matters not
            for value, at in [(0.0, last + timedelta(days=i)) for i in range(1, gap)] + [(revenue, day)]:
                if len(before) == self.days:
                    mean, std = float(np.mean(before)), float(np.std(before, ddof=1))
                    if abs(value - mean) > self.width * std:
                        found.append((key[0], pd.Timestamp(at), float(value), mean, std))
                before = [*before, float(value)][-self.days :]
            last = day
        self.kept.update((last, before))
        names = ["series", "window_start", "revenue", "mean_before", "std_before"]
        yield pd.DataFrame(found, columns=names)

    def close(self) -> None:
        pass


def daily_alert_stream(
    closed: DataFrame, series: Column | None = None, days: int = 28, width: float = 2.0
) -> DataFrame:
    """``daily_alerts`` over a stream of closed days, per series (one, if none is named).

    The days before are kept in the state store, ``days`` numbers per series, so a batch
    reads its own rows only.  Days come in order, as windows close; the days without a row
    between two that have one count as 0.  Needs the RocksDB state store, which is set.
    """
    closed.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    named = closed.select(
        (F.lit("all") if series is None else series.cast("string")).alias("series"),
        "window_start",
        "revenue",
    )
    return named.groupBy("series").transformWithStateInPandas(
        statefulProcessor=_LastDays(days, width),
        outputStructType=ALERT,
        outputMode="Append",
        timeMode="None",
    )


def write_daily_alerts(
    closed: DataFrame, alerts: str, checkpoint: str,
    days: int = 28, width: float = 2.0, once: bool = True,
) -> StreamingQuery:
    """Alerts over a stream of closed days, appended to a Parquet folder."""
    return write_windows(daily_alert_stream(closed, None, days, width), alerts, checkpoint, once)
