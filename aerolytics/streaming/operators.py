"""Structured Streaming forms of the row-at-a-time capabilities.

* J1 continuous scoring: ``readStream`` -> ``PipelineModel.transform`` (stateless) -> sink,
  or ``foreachBatch`` with a stored model into one folder per epoch, which a replay replaces.
* J2 hourly mean per station with a watermark; append mode emits a window once the
  watermark (max event time - delay) passes its end, later rows for it are dropped.
* J3 lag / rolling features with per-station state (:mod:`aerolytics.streaming.lags`).

``withWatermark`` needs a ``timestamp`` (not ``timestamp_ntz``), so naive event time is
read as UTC wall-clock with zone-free conversions (windows align with wall-clock hours in
any session zone).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolytics.functions.calendar import instant_to_ntz, ntz_to_instant
from aerolytics.session import ensure_checkpoint_dir


def read_stream(spark: SparkSession, folder: str, schema, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(folder)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never machine-local)."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def hourly_mean_stream(stream: DataFrame, key: str = "station", time: str = "datetime",
                       value: str = "pm25", delay: str = "1 hour") -> DataFrame:
    """Watermarked tumbling-hour mean per key (append mode)."""
    t = ntz_to_instant(time) if stream.schema[time].dataType.simpleString() == "timestamp_ntz" \
        else F.col(time)
    s = stream.select(F.col(key), t.alias("_t"), F.col(value)).withWatermark("_t", delay)
    agg = s.groupBy(F.window("_t", "1 hour").alias("_w"), F.col(key)).agg(F.avg(value).alias(value))
    return agg.select(key, instant_to_ntz(F.col("_w.start")).alias(time), value)


def run_to_table(spark: SparkSession, df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming query over everything available (``availableNow``) into a Parquet
    sink under the shared checkpoint folder, wait, and return the sink as a table."""
    base = scratch(spark, name)
    q = (df.writeStream.format("parquet").outputMode(mode)
         .option("path", os.path.join(base, "out"))
         .option("checkpointLocation", os.path.join(base, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(os.path.join(base, "out"))


def score_stream(stream: DataFrame, model, features, keep=()) -> DataFrame:
    """Stateless scoring of arriving rows with a fitted pipeline."""
    from aerolytics.operators.models import score_regression
    return score_regression(model, stream, features, keep=keep)


def epoch_sink(model_path: str, features, path: str, keep=()):
    """A ``foreachBatch`` function that scores a micro-batch with the stored model and
    writes it to ``path/epoch=N``. A micro-batch that is run again after a failure has the
    same number and rows, so it replaces its own folder: every row is in the table once."""
    from aerolytics.operators.models import load_model, score_regression
    held: list = []

    def sink(batch: DataFrame, epoch: int) -> None:
        if not held:                                     # loaded once a run, on the driver
            model = load_model(model_path)
            if model is None:
                raise FileNotFoundError(f"no model at {model_path}")
            held.append(model)
        score_regression(held[0], batch, features, keep=keep).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return sink


def run_scoring(stream: DataFrame, sink, checkpoint: str) -> None:
    """Score everything available, one micro-batch after the other, and wait."""
    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def arrive_in_batches(df: DataFrame, folder: str, time: str, batches: int, run) -> None:
    """Append ``df`` to ``folder`` in ``batches`` ranges of ``time`` and call ``run()`` after each,
    as files of a source that grows."""
    lo, hi = df.agg(F.min(time), F.max(time)).first()
    step = (hi - lo) / batches if lo is not None else None
    for i in range(batches):
        part = df
        if i:
            part = part.where(F.col(time) >= F.lit(lo + i * step))
        if i + 1 < batches and lo is not None:
            part = part.where(F.col(time) < F.lit(lo + (i + 1) * step))
        part.write.mode("append").parquet(folder)
        run()
        if lo is None:
            break
