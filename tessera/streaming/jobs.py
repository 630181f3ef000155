"""Structured Streaming jobs: incremental filtering, dedup by key, expiry, windowed counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def json_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """New JSON-lines files of a folder; files_per_trigger limits the rate."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def filter_stream(stream: DataFrame, rule: Callable[[DataFrame], DataFrame], key: str, out: str, checkpoint: str) -> StreamingQuery:
    """Rows that a rule passes, each key once, appended as JSON. The checkpoint is the ledger of what was read."""
    once = stream.dropDuplicates([key])
    writer = rule(once).writeStream.format("json").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(out)


def dedup_with_expiry(stream: DataFrame, key: list[str], time: str, age: str) -> DataFrame:
    """Each key once within `age` of event time; state older than that is dropped."""
    return stream.withWatermark(time, age).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, time: str, by: list[str], size: str, late: str, value: str, slide: str | None = None) -> DataFrame:
    """Counts and sums per window; rows later than `late` are dropped."""
    window = F.window(time, size, slide or size)
    return (
        stream.withWatermark(time, late)
        .groupBy(window.alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total")
    )


def sessions(stream: DataFrame, time: str, by: list[str], gap: str, late: str) -> DataFrame:
    return (
        stream.withWatermark(time, late)
        .groupBy(F.session_window(time, gap).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")
    )


class IdempotentSink:
    """A foreachBatch sink that a crash cannot make repeat: each batch has a folder of its own under `out`, which a batch
    that comes again replaces; behind it its number and rows go to the ledger.

    The order is output first, ledger after, so a crash between the two leaves rows that the ledger does not know. Spark
    then brings the same batch again (its rows are fixed by the checkpoint). rows() reads what is there; ledger() what is
    accounted for. With by_id=False batches are appended, as a plain log would be: then the batch of a crash stands twice.
    """

    def __init__(self, out: str, ledger: str, by_id: bool = True, crash_at: int | None = None):
        self.out, self.ledger_path, self.by_id, self.crash_at = out, ledger, by_id, crash_at

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        if self.by_id:
            rows.write.mode("overwrite").parquet(f"{self.out}/batch={batch_id}")
        else:
            rows.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("append").partitionBy("batch").parquet(self.out)
        if batch_id == self.crash_at:  # for tests: between output and ledger
            self.crash_at = None
            raise RuntimeError(f"stopped behind the output of batch {batch_id}")
        spark = rows.sparkSession
        n = spark.read.schema(rows.schema).parquet(f"{self.out}/batch={batch_id}").count()
        line = spark.range(1).select(F.lit(batch_id).cast("long").alias("batch"), F.lit(n).cast("long").alias("rows"))
        line.coalesce(1).write.mode("overwrite").json(f"{self.ledger_path}/entry={batch_id}")

    def rows(self, spark: SparkSession, schema: str) -> DataFrame:
        """The rows of all batches, with the column batch."""
        return spark.read.schema(f"{schema}, batch bigint").parquet(self.out)

    def ledger(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("batch bigint, rows bigint").json(self.ledger_path)


def live_tail(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, every: str = "1 second") -> StreamingQuery:
    """A query that runs on and looks for new rows `every` so often; stop() it, or let it fail and start it again on the
    same checkpoint."""
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows of a finished query that came behind the watermark and were dropped, as far as its progress is kept."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a streaming frame over what is there and returns the result, read from Parquet at `path`.

    Appended rows go through the file sink; a complete result replaces the one of the batch before.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").start(path).awaitTermination()
    else:
        writer.foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(path)).start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
