"""Stateless and keyed micro-batch jobs.

Every job takes a trigger; ``AVAILABLE`` drains the source and stops. Batch
writers own one folder per batch id, so a batch that is replayed after a
failure replaces what it wrote before.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.functions.device_events import EVENT_SCHEMA, enriched
from tidemark.operators.quality import subscriber_rules, validated, with_status
from tidemark.operators.windows import latest_per_key
from tidemark.sources.scans import envelope
from tidemark.sources.sinks import put_batch
from tidemark.streaming.sources import document_stream, message_stream, record_stream, stage_stream

AVAILABLE = {"availableNow": True}
EVERY_MINUTE = {"processingTime": "1 minute"}

ORDER_COUNTERS = "order_messages"
ORDER_SCHEMA = "order_id string, amount double, order_date string"
PERSON_SCHEMA = "id string, name string, age int"
SUBSCRIBER_SCHEMA = (
    "customer_id string, name string, age int, subscription_type string, signup_date string, active boolean"
)


def enrich_stream(spark: SparkSession, source: str, target: str, checkpoint: str, trigger=AVAILABLE) -> StreamingQuery:
    """Device events to enriched JSON; the file sink writes each batch once."""
    out = enriched(record_stream(spark, source, EVENT_SCHEMA))
    return (
        out.writeStream.format("json").option("checkpointLocation", checkpoint).trigger(**trigger).start(target)
    )


def _each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, trigger) -> StreamingQuery:
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def split_orders(batch: DataFrame, batch_id: int, now: Column, target: str) -> None:
    """One batch of order envelopes: two sinks and the two counters."""
    checked = with_status(envelope(batch.select("body"), ORDER_SCHEMA), now).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for status, name in (("SUCCESS", "success"), ("FAILURE", "failure")):
            chosen = checked.filter(F.col("status") == status)
            chosen.write.mode("overwrite").json(f"{target}/{name}/batch_id={batch_id}")
        counters = checked.groupBy("status").agg(F.count("*").alias("n"))
        counters.write.mode("overwrite").json(f"{target}/counters/batch_id={batch_id}")
    finally:
        checked.unpersist()


def order_stream(
    spark: SparkSession, source: str, target: str, checkpoint: str, now: Column, trigger=AVAILABLE
) -> StreamingQuery:
    handle = lambda batch, batch_id: split_orders(batch, batch_id, now, target)
    return _each_batch(message_stream(spark, source), handle, checkpoint, trigger)


def observed_order_stream(
    spark: SparkSession, source: str, target: str, checkpoint: str, now: Column, trigger=AVAILABLE
) -> StreamingQuery:
    """Order messages to one file sink with a folder per status, counted on the way.

    The sink's commit log makes each row arrive once. The counters are metrics that Spark
    observes while the rows pass, so nothing is kept or read twice: add a
    :class:`BatchCounters` for ``ORDER_COUNTERS`` to write them down.
    """
    checked = with_status(envelope(message_stream(spark, source).select("body"), ORDER_SCHEMA), now)
    success, failure = (F.count_if(F.col("status") == status) for status in ("SUCCESS", "FAILURE"))
    counted = checked.observe(ORDER_COUNTERS, F.count("*").alias("messages"), success.alias("success_count"), failure.alias("failure_count"))
    return (
        counted.writeStream.format("json").partitionBy("status").option("checkpointLocation", checkpoint)
        .trigger(**trigger).start(target)
    )


class BatchCounters(StreamingQueryListener):
    """Writes what each batch of a query observed under ``name``, one folder per batch id.

    A replayed batch replaces its folder. ``wait`` returns once the query's end has been
    heard of, when all its batches are written; it raises what a write raised.
    """

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path
        self.ended, self.problem = threading.Event(), None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        try:
            values = {k: int(v) for k, v in row.asDict().items()}
            schema = ", ".join(f"{k} bigint" for k in values)
            batch = self.spark.createDataFrame([tuple(values.values())], schema)
            batch.write.mode("overwrite").json(f"{self.path}/batch_id={event.progress.batchId}")
        except Exception as problem:  # the listener bus would swallow it; wait() raises it
            self.problem = problem

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def wait(self, seconds: float = 60) -> None:
        if not self.ended.wait(seconds):
            raise TimeoutError(f"no end of the query heard within {seconds} s")
        if self.problem is not None:
            raise self.problem


def counted_run(spark: SparkSession, start: Callable[[], StreamingQuery], name: str, path: str) -> None:
    """Run a draining query to its end with its observed metrics written to ``path``."""
    counters = BatchCounters(spark, name, path)
    spark.streams.addListener(counters)
    try:
        start().awaitTermination()
        counters.wait()
    finally:
        spark.streams.removeListener(counters)


def normalised_persons(df: DataFrame) -> DataFrame:
    return df.withColumn("name", F.upper("name")).withColumn("isAdult", F.col("age") >= 18)


def put_persons(batch: DataFrame, batch_id: int, target: str) -> None:
    """One batch of person messages: normalise, keep the last per id, put."""
    lines = batch.withColumn("line", F.monotonically_increasing_id())  # rises along a block of a file
    decoded = envelope(lines, PERSON_SCHEMA).filter("corrupt IS NULL AND id IS NOT NULL").drop("corrupt")
    last = latest_per_key(
        normalised_persons(decoded), ["id"], [F.desc("arrived"), F.desc("line")]
    )
    put_batch(last.drop("arrived", "line"), target, batch_id)


def person_stream(spark: SparkSession, source: str, target: str, checkpoint: str, trigger=AVAILABLE) -> StreamingQuery:
    """Keyed upserts, at least once: read the table with ``sinks.read_puts``."""
    handle = lambda batch, batch_id: put_persons(batch, batch_id, target)
    return _each_batch(message_stream(spark, source), handle, checkpoint, trigger)


def validate_stream(
    spark: SparkSession, landing: str, passed: str, failed: str, checkpoint: str, trigger=AVAILABLE
) -> tuple[StreamingQuery, StreamingQuery]:
    """Landing documents to the pass and the fail layer.

    Both layers are file sinks: their commit log hides files of an unfinished
    batch, so the next layer reads each validated row once.
    """
    def layer(condition: str, drop: list[str], target: str, name: str) -> StreamingQuery:
        documents = document_stream(spark, landing, SUBSCRIBER_SCHEMA)
        rows = validated(documents, subscriber_rules()).filter(condition).drop(*drop)
        return (
            rows.writeStream.format("json").option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(**trigger).start(target)
        )

    return (
        layer("passed", ["passed", "reason"], passed, "passed"),
        layer("NOT passed", ["passed"], failed, "failed"),
    )


def subscription_metrics_stream(
    spark: SparkSession, passed: str, target: str, checkpoint: str, trigger=AVAILABLE
) -> StreamingQuery:
    """Customers per subscription over all validated files so far.

    Each batch owns a folder, so a failed write leaves the totals before it; read
    them with ``sinks.read_newest``.
    """
    rows = spark.readStream.schema(SUBSCRIBER_SCHEMA).json(passed)
    counts = rows.groupBy("subscription_type").agg(F.count("*").alias("customers"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").json(f"{target}/batch_id={batch_id}")

    return (
        counts.writeStream.outputMode("complete").foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def bulk_load_stream(
    spark: SparkSession, stage: str, columns: Sequence[tuple[str, str, str]], target: str, checkpoint: str,
    separator: str = ",", trigger=AVAILABLE,
) -> StreamingQuery:
    """Load each stage file once: positional columns, cast, appended to a table path."""
    rows = stage_stream(spark, stage, len(columns), separator)
    typed = rows.select(*[F.col(src).cast(kind).alias(dst) for src, kind, dst in columns])
    return (
        typed.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .trigger(**trigger).start(target)
    )


def periodic_refresh(
    ticks: DataFrame, refresh: Callable[[SparkSession], None], checkpoint: str, trigger=EVERY_MINUTE
) -> StreamingQuery:
    """Run a batch statement on every trigger of ``ticks`` (for instance a rate source)."""
    handle = lambda batch, batch_id: refresh(batch.sparkSession)
    return _each_batch(ticks, handle, checkpoint, trigger)
