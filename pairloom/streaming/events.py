"""Structured Streaming over the event table: windows, deduplication and state per key.

``collect_stream`` runs a streaming query over all there is and returns its rows as a table in the shared folder. Its
checkpoint lies there too, so a run that dies goes on where it stopped; each batch replaces what it had written, so
none counts twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pairloom.session import through_folder


def event_stream(spark: SparkSession, sf_dir: str, name: str = "events", ts: str = "ts", files_per_batch: int | None = None) -> DataFrame:
    """The table as a stream, its time as a timestamp; ``files_per_batch`` holds back the rest (back-pressure)."""
    path = f"{sf_dir}/{name}.parquet"
    read = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        read = read.option("maxFilesPerTrigger", files_per_batch)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
    stream = read.parquet(path) if folder else read.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def collect_stream(df: DataFrame, mode: str = "append") -> DataFrame:
    """The rows of a streaming query over all its input: of every batch, in ``complete`` mode of the last one."""
    return through_folder(df.sparkSession, "stream", lambda at: _collected(df, mode, at))


def _collected(df: DataFrame, mode: str, at: str) -> DataFrame:
    spark = df.sparkSession

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/rows/batch={number}")

    q = df.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).foreachBatch(put).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/rows")
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], df.schema)
    rows = spark.read.parquet(f"{at}/rows")
    if mode == "complete":
        rows = rows.where(F.col("batch") == rows.agg(F.max("batch")).first()[0])
    return rows.drop("batch")


def tumbling(events: DataFrame, length: str = "1 hour", late: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", length), "event_type")
    return w.agg(F.count("*").alias("n")).select(F.unix_timestamp("window.start").alias("start"), "event_type", "n")


def sliding(events: DataFrame, length: str = "2 hours", step: str = "1 hour", late: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", length, step))
    return w.agg(F.count("*").alias("n"), F.max("value").alias("highest")).select(F.unix_timestamp("window.start").alias("start"), "n", "highest")


def sessions(events: DataFrame, gap: str = "6 hours", late: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id")
    return w.agg(F.count("*").alias("n")).select("user_id", F.unix_micros("session_window.start").alias("start"), "n")


def first_of_each(events: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that come, each once."""
    return events.select(*keys).dropDuplicates(keys)


def running_counts(events: DataFrame, key: str = "user_id") -> DataFrame:
    """Per key how many events it has had and how many kinds, kept as state between batches."""

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, kinds = state.get if state.exists else (0, "")
        seen = set(filter(None, kinds.split("|")))
        for f in frames:
            n += len(f)
            seen |= set(f["event_type"].dropna())
        state.update((n, "|".join(sorted(seen))))
        yield pd.DataFrame({key: [k[0]], "n": [n], "kinds": ["|".join(sorted(seen))]})

    kind = events.schema[key].dataType.simpleString()
    return events.select(key, "event_type").groupBy(key).applyInPandasWithState(update, f"{key} {kind}, n long, kinds string", "n long, kinds string", "update", GroupStateTimeout.NoTimeout)
