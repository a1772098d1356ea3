"""Message topics: read, decode, parse, publish.

The broker connector is a separate Spark package (``spark-sql-kafka-0-10``);
pass it to ``spark-submit``.  The JSON path also reads plain files of messages,
as stream or batch; Avro is decoded by this library (``avro``).
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch import schema
from ledgerwatch.functions.times import as_instant, event_time
from ledgerwatch.sources import avro

ORIGIN = ["kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp"]
CORRUPT = "_corrupt_record"


def read_topic_stream(spark, servers, topic, starting="latest", per_trigger=10000,
                      protocol="PLAINTEXT", **options):
    """A topic as a stream, with start position and rate limit."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.security.protocol", protocol)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", per_trigger)
    )
    return project_topic(reader.options(**options).load())


def read_topic_batch(spark, servers, topic, starting="earliest", ending="latest",
                     protocol="PLAINTEXT", **options):
    """A bounded read of a topic."""
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.security.protocol", protocol)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("endingOffsets", ending)
    )
    return project_topic(reader.options(**options).load())


def project_topic(df):
    """Message columns under the names the rest of the library uses.

    ``value`` stays binary for Avro and is cast to text by ``decode``.
    """
    return df.select(
        F.col("value"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def read_message_files(spark, path, stream=False, files_per_trigger=None, **options):
    """Lines of JSON messages in files; the file stands in for topic and offset."""
    reader = spark.readStream if stream else spark.read
    reader = reader.format("text").options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select(
        "value",
        F.lit(None).cast("string").alias("kafka_key"),
        F.col("_metadata.file_name").alias("kafka_topic"),
        F.lit(0).alias("kafka_partition"),
        F.col("_metadata.file_block_start").alias("kafka_offset"),
        F.col("_metadata.file_modification_time").alias("kafka_timestamp"),
    )


def decode_avro(df, avro_schema):
    """Avro messages behind the registry's 5-byte header, as the wire struct ``t``.

    Names are those of the wire struct, types are brought to its types; a broken message has no ``t`` and
    its bytes in base64 as ``_corrupt_record``.  Message columns stay.
    """
    found = df.withColumn("t", avro.from_avro(F.col("value"), avro_schema))
    have = found.schema["t"].dataType
    return found.withColumns({
        "t": _as_wire(F.col("t"), have, schema.WIRE),
        CORRUPT: F.when(F.col("t").isNull(), F.base64("value")),
    })


def _as_wire(value, have, want):
    """``value`` of type ``have`` as ``want``; times as ISO text in UTC, unknown fields left out."""
    if isinstance(want, T.StructType):
        parts = [
            (_as_wire(value[f.name], have[f.name].dataType, f.dataType) if f.name in have.names
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(have, T.TimestampType) and isinstance(want, T.StringType):
        return F.date_format(F.to_utc_timestamp(value, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return value.cast(want)


def parse_messages(df):
    """JSON text to the wire struct, keeping what could not be parsed.

    Adds ``t`` and ``_corrupt_record``; message columns stay.
    """
    wire = T.StructType([*schema.WIRE.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col("value").cast("string"), wire,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    return df.withColumn("t", parsed).withColumn(CORRUPT, F.col(f"t.{CORRUPT}"))


def is_malformed():
    """True where nothing of the message could be parsed."""
    nothing = F.lit(True)
    for name in schema.WIRE.names:
        nothing = nothing & F.col(f"t.{name}").isNull()
    return nothing


def split_malformed(parsed):
    """(parsed rows, quarantine rows with the raw text and its origin)."""
    good = parsed.filter(~is_malformed())
    bad = parsed.filter(is_malformed()).select(
        F.coalesce(CORRUPT, F.col("value").cast("string")).alias("raw"), *[c for c in ORIGIN if c in parsed.columns]
    )
    return good, bad


def flatten(parsed, **extra):
    """Typed transaction columns with origin and ingest time.

    Times accept epoch milliseconds or ISO text; coordinates accept either
    spelling of their keys.
    """
    t = lambda name: F.col(f"t.{name}")
    location = F.when(
        t("location").isNotNull(),
        F.struct(
            t("location.country").alias("country"), t("location.state").alias("state"),
            t("location.city").alias("city"), t("location.zip_code").alias("zip_code"),
            F.coalesce(t("location.latitude"), t("location.lat")).alias("latitude"),
            F.coalesce(t("location.longitude"), t("location.lon")).alias("longitude"),
        ),
    )
    special = {
        "timestamp": event_time(t("timestamp"), t("created_at")),
        "created_at": as_instant(t("created_at")),
        "location": location,
    }
    return parsed.select(
        *[special.get(name, t(name)).alias(name) for name in schema.TRANSACTION.names],
        *[c for c in ORIGIN if c in parsed.columns],
        F.current_timestamp().alias("ingested_at"),
        *[c.alias(name) for name, c in extra.items()],
    )


def parse_transactions(messages):
    """Messages to typed transactions; malformed ones come out as all-NULL rows."""
    return flatten(parse_messages(messages))


def as_messages(df, key, columns=None):
    """Rows as (key, JSON value) pairs for a topic."""
    body = F.struct(*(columns or df.columns))
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(body).alias("value"))


def publish(df, servers, topic, key, **options):
    """Write a batch frame to a topic, keyed."""
    (
        as_messages(df, key).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .options(**options).save()
    )


def publish_stream(df, servers, topic, key, checkpoint, **options):
    """Write a stream to a topic, keyed; returns the running query."""
    return (
        as_messages(df, key).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint).options(**options).start()
    )
