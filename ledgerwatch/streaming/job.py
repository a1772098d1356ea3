"""The streaming job: one query, one pass over the source, five tables.

source -> parse -> flags -> hash -> per-customer state -> foreachBatch, which
writes bronze, quarantine, silver, alerts and quality metrics from one stored
micro-batch.  A batch's folders are named by run (the checkpoint) and batch and
show in all tables at once, by one commit (``commits``): a replay after a
failure leaves the same rows, and a new checkpoint adds to old tables.  Silver
has an id once, whatever its date and whichever run wrote it (``ids``).
"""

import time
from dataclasses import dataclass, field

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ledgerwatch import schema
from ledgerwatch.config import PipelineConfig
from ledgerwatch.operators import alerts, dedup, detect, monitor, quality, validate
from ledgerwatch.plans import medallion
from ledgerwatch.sources import messages
from ledgerwatch.sources.commits import Commits, run_of
from ledgerwatch.streaming import ids
from ledgerwatch.streaming.state import HISTORY_PATTERNS, add_features_stream


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ADAPTIVE = "spark.sql.adaptive.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Job:
    """Where and how the streaming job writes."""

    root: str
    checkpoint: str
    cfg: PipelineConfig = field(default_factory=PipelineConfig)
    as_of: object = None
    trigger_seconds: int = 30
    late_hours: int = 2
    alert_servers: str = ""
    alert_topic: str = ""  # alerts also go to this topic, keyed by transaction
    history_patterns: bool = True  # alert on the six patterns that need a history, too
    compact_every: int = 20  # batches
    most_folders: int = 8  # of a table, after a compaction

    def path(self, table):
        return f"{self.root}/{table}"


def from_messages(message_stream):
    """A message stream as typed rows; ``raw`` holds the text of messages nothing could read."""
    parsed = messages.parse_messages(message_stream)
    raw = F.when(messages.is_malformed(), F.col("value").cast("string"))
    return messages.flatten(parsed, raw=raw)


def enriched_stream(transactions, job):
    """Flags, hashed customer and features of a transaction stream."""
    secured = medallion.secured(transactions, job.cfg, job.as_of)
    return add_features_stream(
        secured, job.cfg.features, job.late_hours, job.cfg.detectors, job.cfg.quality)


def drop_duplicates_within_watermark(transactions, delay="2 hours"):
    """Duplicate removal that trades lateness for bounded state: rows behind the mark are lost."""
    return transactions.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(
        ["transaction_id"])


def _with_customer(rows):
    """Rows as the rules want them; in production the hash stands for the dropped clear id."""
    if "customer_id" in rows.columns:
        return rows
    known = F.col("customer_id_hash") != schema.UNKNOWN_CUSTOMER
    return rows.withColumn("customer_id", F.when(known, F.col("customer_id_hash")))


def patterned(silver, cfg):
    """Written silver rows with all pattern columns, as the alert rules want them."""
    rows = silver.withColumnRenamed("transaction_timestamp", "timestamp").withColumns({
        p: F.array_contains(F.coalesce("stream_patterns", F.array().cast("array<string>")), p)
        for p in HISTORY_PATTERNS})
    return detect.add_row_patterns(rows, cfg)


def write_batch(job):
    """The foreachBatch function of the job."""

    def write(batch, batch_id):
        began = time.monotonic()
        spark = batch.sparkSession
        commits = Commits(spark, job.root)
        run, state = run_of(spark, job.checkpoint), commits.state()
        if state.batches.get(run, -1) >= batch_id:
            return  # a replay of a batch that is in the tables
        folder, added = f"run={run}/batch_id={batch_id}", {}

        def put(df, table, *partition):
            df.write.mode("overwrite").partitionBy(*partition).parquet(f"{job.path(table)}/{folder}")
            added[table] = [folder]

        batch.persist()
        # a stream's session has it off for its state; what is made of a batch has as many tasks and files as its rows want
        before = spark.conf.get(ADAPTIVE)
        spark.conf.set(ADAPTIVE, "true")
        try:
            rows = batch
            if "raw" in batch.columns:
                rows = batch.filter(F.col("raw").isNull()).drop("raw")
                put(batch.filter(F.col("raw").isNotNull()).select("raw", *messages.ORIGIN), "quarantine")
            put(quality.bronze_projection(rows), "bronze")

            passing = quality.passing_quality(rows, job.cfg.quality)
            first = dedup.keep_first(
                passing, ["transaction_id"], ["timestamp", "kafka_partition", "kafka_offset"])
            silver = quality.silver_projection(first, job.as_of, ["features_complete", "stream_patterns"])
            known = ids.repeated(commits, state, silver)
            put(silver.join(known, "transaction_id", "left_anti").select(silver.columns), "silver",
                "transaction_date")

            written = spark.read.schema(silver.schema).parquet(f"{job.path('silver')}/{folder}")
            ids.write(put, written.select("transaction_id"))
            fired = patterned(written, job.cfg.detectors)
            if not job.history_patterns:
                fired = fired.drop(*HISTORY_PATTERNS)
            put(alerts.build_alerts(fired, job.cfg.detectors, job.as_of), "alerts")

            if job.alert_topic:
                sent = spark.read.schema(schema.ALERT_DDL).parquet(f"{job.path('alerts')}/{folder}")
                messages.publish(sent, job.alert_servers, job.alert_topic, "transaction_id")

            checked = validate.validate_transactions(
                _with_customer(rows), job.cfg.quality, job.as_of)
            metrics = monitor.history_rows(
                monitor.batch_summary(checked, seconds=time.monotonic() - began),
                F.current_timestamp())
            put(metrics, "quality")
            commits.commit({"run": run, "batch": batch_id, "add": added})
            if job.compact_every and batch_id % job.compact_every == job.compact_every - 1:
                maintain(spark, job)
        finally:
            batch.unpersist()
            spark.conf.set(ADAPTIVE, before)

    return write


def maintain(spark, job, keep_versions=10):
    """Bring the number of folders down and delete what no reader can still want."""
    commits = Commits(spark, job.root)
    for table in TABLES:
        commits.compact(table, table_schema(table),
                        ["transaction_date"] if table == "silver" else [], job.most_folders)
    ids.compact(commits, job.most_folders)
    commits.vacuum(keep_versions)


def start(transactions, job, available_now=False, name="transactions"):
    """Start the job on a transaction stream; returns the running query."""
    transactions.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    writer = (
        enriched_stream(transactions, job).writeStream.queryName(name)
        .outputMode("append").option("checkpointLocation", job.checkpoint)
        .foreachBatch(write_batch(job))
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{job.trigger_seconds} seconds").start()


TABLES = {
    "bronze": (schema.BRONZE_DDL, ""),
    "silver": (schema.SILVER_DDL, ", features_complete boolean, stream_patterns array<string>"),
    "alerts": (schema.ALERT_DDL, ""),
    "quarantine": (
        "raw string, kafka_topic string, kafka_partition int, kafka_offset long, "
        "kafka_timestamp timestamp", ""),
    "quality": (
        "metric_time timestamp, quality_score double, validation_rate double, batch_size long, "
        "processing_seconds double, error_count long", ""),
}


def table_schema(table):
    columns, extra = TABLES[table]
    return f"{columns.strip()}{extra}, batch_id long"


def read_table(spark, job, table):
    """The committed rows of a table the job has written; its schema is declared, so it may be empty."""
    return Commits(spark, job.root).read(table, table_schema(table))


def stop(queries):
    """Stop the given queries; the session stays."""
    for q in queries:
        q.stop()


def status(spark, queries):
    """One row per query: id, name, state and the last batch's figures."""
    rows = []
    for q in queries:
        p = q.lastProgress
        rows.append((
            str(q.id), q.name, "ACTIVE" if q.isActive else "TERMINATED",
            int(p["batchId"]) if p else None, int(p["numInputRows"]) if p else None,
            float(p["processedRowsPerSecond"] or 0.0) if p else None,
            int(p["durationMs"].get("triggerExecution", 0)) if p else None,
        ))
    return spark.createDataFrame(
        rows, "id string, name string, state string, batch_id long, input_rows long, "
              "rows_per_second double, trigger_ms long")


class ProgressLog(StreamingQueryListener):
    """Appends one row per finished micro-batch to a table of progress figures."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        row = self.spark.range(1).select(
            F.lit(str(p.id)).alias("query_id"), F.lit(p.name).alias("name"),
            F.lit(p.batchId).cast("long").alias("batch_id"),
            F.lit(p.timestamp).cast("timestamp").alias("started_at"),
            F.lit(p.numInputRows).cast("long").alias("input_rows"),
            F.lit(float(p.processedRowsPerSecond)).alias("rows_per_second"),
            F.lit(p.batchDuration).cast("long").alias("batch_ms"),
        )
        row.write.mode("append").parquet(self.path)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
