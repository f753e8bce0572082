"""O-01: post-deployment monitoring of a prediction stream.

Each event is a scored prediction: ``event_type`` is the predicted class and
``value`` (scaled to [0, 1] by a fitted maximum) is the model's confidence.
Per tumbling window (7 days by default) the monitor reports the volume, the
share of confident predictions (coverage), the predicted-class mix, the
manual-correction rate (share of the correction class) and the drift of the
class mix against a baseline fitted on a static reference table.

The same :func:`window_metrics` runs on a streaming DataFrame (Structured
Streaming, event-time watermark, append mode, checkpointed in the shared
checkpoint folder) and on a batch DataFrame, so the stream can be checked
against its batch twin. Baseline values are a handful of numbers fitted once
and applied as literals — no stream-static join after the aggregation.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from tessera.session import checkpoint_dir

EVENT_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()), StructField("event_type", StringType()),
    StructField("value", DoubleType()), StructField("props", StringType()),
])

# Predicted classes of the monitored stream and the class that
# marks a manual correction.
CLASSES = ("click", "error", "purchase", "signup", "view")
CORRECTION_CLASS = "error"


def fit_baseline(reference: DataFrame, classes=CLASSES) -> dict:
    """Class shares and the confidence scale (max value) of the reference."""
    row = reference.agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("vmax"),
                        *[F.count_if(F.col("event_type") == c).alias(f"n_{c}") for c in classes]).first()
    shares = {c: row[f"n_{c}"] / row["n"] for c in classes}
    return {"scale": float(row["vmax"]), **shares, "other": max(0.0, 1.0 - sum(shares.values()))}


def window_metrics(events: DataFrame, baseline: dict, window: str = "7 days", threshold: float = 0.5,
                   watermark: str | None = "1 day", classes=CLASSES) -> DataFrame:
    """Tumbling-window monitoring aggregate (streaming or batch input)."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if watermark:
        e = e.withWatermark("ts", watermark)
    conf = F.col("value") / F.lit(baseline["scale"])
    agg = e.groupBy(F.window("ts", window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(conf >= threshold).alias("n_confident"),
        *[F.count_if(F.col("event_type") == c).alias(f"n_{c}") for c in classes])
    out = agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n",
                     (F.col("n_confident") / F.col("n")).alias("coverage"),
                     (F.col(f"n_{CORRECTION_CLASS}") / F.col("n")).alias("correction_rate"),
                     *[(F.col(f"n_{c}") / F.col("n")).alias(f"share_{c}") for c in classes])
    out = out.withColumn("share_other", F.greatest(F.lit(1.0) - sum(F.col(f"share_{c}") for c in classes), F.lit(0.0)))
    drift = sum(F.abs(F.col(f"share_{c}") - F.lit(baseline[c])) for c in (*classes, "other")) / 2.0
    return out.withColumn("mix_drift", drift)


def run_stream(spark: SparkSession, source_dir: str, baseline: dict, file_glob: str = "*.parquet",
               window: str = "7 days", threshold: float = 0.5, watermark: str = "1 day",
               out_dir: str | None = None) -> DataFrame:
    """Run the monitor as a Structured Streaming query over the files of
    ``source_dir`` matching ``file_glob`` (available-now trigger), appending closed windows to a
    Parquet table in the shared checkpoint folder, and return that table.

    Checkpoint and output live under ``out_dir``: a monitor that must resume
    after a restart passes the same folder again and goes on from the last
    committed batch. Without it every call is a run of its own in a fresh folder
    under ``spark.checkpoint.dir``. The last windows stay open until later events
    pass the watermark; :func:`open_windows` reports them."""
    base = out_dir or os.path.join(checkpoint_dir(spark), f"monitor-{uuid.uuid4().hex}")
    stream = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", file_glob).parquet(source_dir)
    metrics = window_metrics(stream, baseline, window, threshold, watermark)
    q = (metrics.writeStream.outputMode("append").format("parquet")
         .option("path", os.path.join(base, "out"))
         .option("checkpointLocation", os.path.join(base, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(metrics.schema).parquet(os.path.join(base, "out"))


def open_windows(events: DataFrame, closed: DataFrame, baseline: dict, window: str = "7 days",
                 threshold: float = 0.5) -> DataFrame:
    """Metrics so far of the windows that the stream has not closed: a batch over
    the events from the last closed window's end on (the filter reaches the scan)."""
    last = closed.agg(F.max("window_end")).first()[0]
    rest = events if last is None else events.filter(F.col("ts") >= F.lit(last))
    return window_metrics(rest, baseline, window, threshold, watermark=None)


def closed_windows(batch_metrics: DataFrame, events: DataFrame, watermark_days: int = 1) -> DataFrame:
    """Batch twin restricted to the windows a watermarked stream has emitted
    (window end ≤ max event time − watermark)."""
    mx = events.agg(F.max("ts")).first()[0]
    return batch_metrics.filter(F.col("window_end") <= F.lit(mx) - F.expr(f"INTERVAL {watermark_days} DAYS"))


# ---------------------------------------------- drift from an earlier period
def store_baseline(events: DataFrame, until, path: str, classes=CLASSES) -> None:
    """Fit the baseline on the events before ``until`` and save it under
    ``path`` (a Parquet table of one row per class, in a shared folder)."""
    base = fit_baseline(events.filter(F.col("ts") < F.lit(until)), classes)
    rows = [(c, base[c], base["scale"], until) for c in (*classes, "other")]
    events.sparkSession.createDataFrame(rows, "class string, share double, scale double, until timestamp_ntz") \
        .coalesce(1).write.mode("overwrite").parquet(path)


def load_baseline(spark: SparkSession, path: str) -> dict:
    """The saved baseline, with the end of its period under ``until``."""
    rows = spark.read.parquet(path).collect()                       # one row per class
    return {"scale": rows[0]["scale"], "until": rows[0]["until"], **{r["class"]: r["share"] for r in rows}}


def day_counts(events: DataFrame, baseline: dict, threshold: float = 0.5, watermark: str | None = "1 day",
               classes=CLASSES) -> DataFrame:
    """Counts per day (stream or batch) of the events from the end of the
    baseline's period on. Days add up to weeks and months, so one stream state
    serves every period of :func:`period_drift`."""
    e = events.filter(F.col("ts") >= F.lit(baseline["until"])).withColumn("ts", F.col("ts").cast("timestamp"))
    if watermark:
        e = e.withWatermark("ts", watermark)
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") / F.lit(baseline["scale"]) >= threshold).alias("n_confident"),
              *[F.count_if(F.col("event_type") == c).alias(f"n_{c}") for c in classes]]
    d = e.groupBy(F.window("ts", "1 day").alias("w")).agg(*counts)
    return d.select(F.col("w.start").cast("timestamp_ntz").alias("day"), *[c for c in d.columns if c != "w"])


def run_day_stream(spark: SparkSession, source_dir: str, baseline: dict, out_dir: str, file_glob: str = "*.parquet",
                   threshold: float = 0.5, watermark: str = "1 day") -> DataFrame:
    """Append the closed days of the files of ``source_dir`` to ``out_dir``
    (available-now; the same folder again goes on from the last batch)."""
    stream = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", file_glob).parquet(source_dir)
    days = day_counts(stream, baseline, threshold, watermark)
    days.writeStream.outputMode("append").format("parquet").option("path", os.path.join(out_dir, "days")) \
        .option("checkpointLocation", os.path.join(out_dir, "ckpt")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(days.schema).parquet(os.path.join(out_dir, "days"))


def period_drift(days: DataFrame, baseline: dict, periods=("week", "month"), classes=CLASSES) -> DataFrame:
    """(period, start, n, coverage, correction_rate, share_<class>, mix_drift)
    for calendar weeks (from Monday) and months: sums over the day counts. The
    drift is half the summed distance of the class shares from the baseline's."""
    sums = [F.sum(c).alias(c) for c in days.columns if c != "day"]
    starts = F.array(*[F.struct(F.lit(p).alias("period"), F.date_trunc(p, F.col("day").cast("timestamp")).cast("timestamp_ntz").alias("start"))
                       for p in periods])
    t = days.withColumn("__at", F.explode(starts)).groupBy("__at.period", "__at.start").agg(*sums)
    share = {c: F.col(f"n_{c}") / F.col("n") for c in classes}
    share["other"] = (F.col("n") - sum(F.col(f"n_{c}") for c in classes)) / F.col("n")
    drift = sum(F.abs(s - F.lit(baseline[c])) for c, s in share.items()) / 2.0
    return t.select("period", "start", "n", (F.col("n_confident") / F.col("n")).alias("coverage"),
                    share[CORRECTION_CLASS].alias("correction_rate"),
                    *[s.alias(f"share_{c}") for c, s in share.items()], drift.alias("mix_drift"))
