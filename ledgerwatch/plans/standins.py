"""Stand-in transactions derived from the generic tables.

``txn_events`` turns the event table into card transactions with a fixed share
of bad rows; ``txn_orders`` turns order lines into transactions whose amounts,
merchants and customers suit the gold tables.  Both are deterministic, so the
same rows can be written in SQL.
"""

import json

from pyspark.sql import functions as F

from ledgerwatch import schema
from ledgerwatch.operators import features, skew
from ledgerwatch.session import fresh_dir, store, store_clustered
from ledgerwatch.sources import avro

AS_OF = "2024-01-30 22:00:00"

# Fixed values of the stand-ins.
TOPIC_PARTITIONS = 6
SEGMENT_OFFSETS = 10_000
LINE_BUCKET_ROWS = 500_000
COUNTRIES = ["US", "CA", "GB", "JP", "DE"]
PATTERNS = [
    "account_takeover", "card_testing", "velocity_attack", "geographic_impossible",
    "amount_probing", "merchant_collusion", "synthetic_identity", "bust_out_fraud",
]


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def txn_events(spark, sf_dir):
    """The event transactions, dealt over the segments of the topic.

    The events are narrow and what is done with them is not: without it the tasks follow the file's
    row groups, and a file of one is worked on by one task.
    """
    e = F.col("event_id")
    return events_as_transactions(
        table(spark, sf_dir, "events").repartition(e % TOPIC_PARTITIONS, F.floor(e / SEGMENT_OFFSETS)))


def events_as_transactions(events):
    e = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    every = lambda n: e % n == 0
    ts = F.col("ts").cast("timestamp")
    value = F.col("value").cast("decimal(12,2)")
    return events.select(
        F.when(every(89), F.concat(F.lit("txn-"), e.cast("string")))
        .otherwise(F.concat(F.lit("00000000-0000-4000-8000-"),
                            F.format_string("%012x", e))).alias("transaction_id"),
        ts.alias("timestamp"),
        F.when(every(211), F.lit(None)).when(every(223), F.lit(""))
        .otherwise(F.concat(F.lit("cust_"), F.col("user_id").cast("string"))).alias("customer_id"),
        F.lpad((e % 10000).cast("string"), 4, "0").alias("card_number_last4"),
        pick(schema.CARD_TYPES, e % 3).alias("card_type"),
        F.when(every(97), -value).when(every(101), value * 1000).when(every(103), F.lit(None))
        .otherwise(value).cast("decimal(10,2)").alias("amount"),
        F.when(every(109), F.lit("XXX")).when(every(113), F.lit("usd"))
        .otherwise(pick(schema.CURRENCIES, k % 5)).alias("currency"),
        F.concat(F.lit("merch_"), k.cast("string")).alias("merchant_id"),
        F.concat(F.lit('<Shop> "'), k.cast("string"), F.lit("\" & Son's")).alias("merchant_name"),
        F.lpad((k + 5000).cast("string"), 4, "0").alias("merchant_category_code"),
        pick(schema.MERCHANT_CATEGORIES, k % 15).alias("merchant_category"),
        F.struct(
            pick(COUNTRIES, k % 5).alias("country"),
            F.concat(F.lit("S"), (k % 7).cast("string")).alias("state"),
            F.concat(F.lit("City"), (k % 20).cast("string")).alias("city"),
            F.lpad((k * 37).cast("string"), 5, "0").alias("zip_code"),
            (((k * 7) % 120) - 60).cast("double").alias("latitude"),
            (((k * 13) % 360) - 180).cast("double").alias("longitude"),
        ).alias("location"),
        pick(schema.CHANNELS, e % 5).alias("channel"),
        F.when(every(127), F.lit("LOST"))
        .when(F.col("event_type") == "purchase", F.lit("APPROVED"))
        .when(F.col("event_type") == "error", F.lit("DECLINED"))
        .when(F.col("event_type") == "view", F.lit("PENDING"))
        .when(F.col("event_type") == "click", F.lit("CANCELLED"))
        .otherwise(F.lit("REFUNDED")).alias("status"),
        ((e % 100).cast("double") / 100).alias("risk_score"),
        F.concat(F.lit("AUTH"), e.cast("string")).alias("authorization_code"),
        F.when(F.col("event_type") == "error", F.lit("05")).otherwise(F.lit("00"))
        .alias("processor_response_code"),
        (k % 10 == 0).alias("is_international"),
        (e % 4 != 0).alias("customer_present"),
        pick(schema.ENTRY_METHODS, e % 5).alias("entry_method"),
        F.map_filter(
            F.create_map(
                F.lit("merchant_risk_score"),
                F.when(k % 7 == 0, F.lit("0.9")).when(k % 7 == 1, F.lit("n/a")),
                F.lit("contact_email"),
                F.concat(F.lit("user."), F.col("user_id").cast("string"), F.lit("@mail.shop.com")),
                F.lit("Phone"),
                F.concat(F.lit("415-555-"), F.lpad((e % 10000).cast("string"), 4, "0")),
                F.lit("fraud_pattern"), F.when(every(50), pick(PATTERNS, (e / 50).cast("int") % 8)),
            ),
            lambda key, v: v.isNotNull(),
        ).alias("metadata"),
        (ts + F.expr("INTERVAL 1 SECOND")).alias("created_at"),
        F.lit("1.0").alias("version"),
        F.lit("transactions").alias("kafka_topic"),
        (e % TOPIC_PARTITIONS).cast("int").alias("kafka_partition"),
        e.alias("kafka_offset"),
        ts.alias("kafka_timestamp"),
        ts.alias("ingested_at"),
    )


def txn_orders(spark, sf_dir):
    """Order lines as transactions: customer = buyer, merchant = supplier."""
    return lines_as_transactions(order_lines(spark, sf_dir))


LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity",
        "l_returnflag", "l_linestatus"]


def order_lines(spark, sf_dir):
    """The order lines with their order, buyer and part: the few columns that the transactions follow from."""
    line = table(spark, sf_dir, "lineitem").select(LINE)
    part = table(spark, sf_dir, "part").select("p_partkey")
    return (
        line.join(buyers(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .drop("o_orderkey", "p_partkey")
    )


def buyers(spark, sf_dir):
    """The orders with their customer, joined before the many lines come in."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")


def order_lines_in_buckets(spark, sf_dir, hashed):
    """The rows of ``order_lines``, with the columns that ``hashed`` adds to the buyers, from two stored tables.

    Lines and buyers lie in buckets of orders, so the join may be run again and shuffles nothing.  Compressed
    columns take half the bytes of shuffled rows, and the joined rows, which are wider, are not stored.
    """
    lines = lines_of_parts(
        table(spark, sf_dir, "lineitem").select(LINE).filter("l_orderkey IS NOT NULL"), table(spark, sf_dir, "part"))
    # the buckets of the joined rows follow: each task that reads one of these writes a file for each of those
    buckets = skew.buckets_for(lines, LINE_BUCKET_ROWS)
    some = spark.table(store_clustered(lines, "lines-by-order", "l_orderkey", buckets))
    who = spark.table(store_clustered(hashed(buyers(spark, sf_dir)), "buyers-by-order", "o_orderkey", buckets))
    return some.hint("merge").join(who, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def lines_of_parts(lines, part):
    """``lines`` joined with ``part``, of which no column is kept, without moving the lines.

    Only the distinct part keys are: those that ``part`` lacks or repeats are stored, and joined by their
    measured size if there are any.
    """
    lines = lines.filter("l_partkey IS NOT NULL")
    copies = part.groupBy("p_partkey").agg(F.count("*").alias("_copies"))
    odd = store(
        lines.select("l_partkey").distinct().join(copies, F.col("l_partkey") == F.col("p_partkey"), "left")
        .select("l_partkey", F.coalesce("_copies", F.lit(0)).cast("int").alias("_copies")).filter("_copies <> 1"),
        "odd-parts")
    if odd.isEmpty():
        return lines
    times = F.sequence(F.lit(1), F.coalesce("_copies", F.lit(1)))
    return lines.join(odd, "l_partkey", "left").filter("_copies IS NULL OR _copies > 0").withColumn(
        "_copy", F.explode(times)).select(lines.columns)


def buyer():
    return F.concat(F.lit("cust_"), F.col("o_custkey").cast("string"))


def lines_as_transactions(lines, *more):
    """The transactions of ``order_lines``; columns ``more`` of the lines come along."""
    k = F.col("l_suppkey")
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.col("l_quantity").cast("int")).alias("transaction_id"),
        (F.col("o_orderdate").cast("timestamp")
         + F.make_dt_interval(F.lit(0), F.lit(9), F.col("l_linenumber") * 8)
         ).alias("timestamp"),
        buyer().alias("customer_id"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
        F.lit("USD").alias("currency"),
        F.concat(F.lit("merch_"), k.cast("string")).alias("merchant_id"),
        F.concat(F.lit("Store "), k.cast("string")).alias("merchant_name"),
        pick(schema.MERCHANT_CATEGORIES, F.col("l_partkey") % 15).alias("merchant_category"),
        F.struct(
            F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"),
            F.col("c_mktsegment").alias("state"),
            F.concat(F.lit("City"), (k % 20).cast("string")).alias("city"),
            F.lit(None).cast("string").alias("zip_code"),
            (((k * 7) % 120) - 60).cast("double").alias("latitude"),
            (((k * 13) % 360) - 180).cast("double").alias("longitude"),
        ).alias("location"),
        pick(schema.CHANNELS, F.col("l_linenumber") % 5).alias("channel"),
        F.when(F.col("l_returnflag") == "R", F.lit("REFUNDED"))
        .when(F.col("l_returnflag") == "A", F.lit("APPROVED"))
        .when(F.col("l_linestatus") == "O", F.lit("DECLINED"))
        .otherwise(F.lit("PENDING")).alias("status"),
        (F.col("l_partkey") % 4 == 0).alias("is_international"),
        (k % 3 == 0).alias("customer_present"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
        *more,
    )


_STORED = {}


def stored(spark, sf_dir, name, build):
    """A derived table, written to the shared folder once per session and read back.

    The stages of the pipeline hand over tables, not plans: features are read
    several times by the detectors, and a written table also cuts the lineage.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        df = build(spark, sf_dir)
        path = fresh_dir(spark, name)
        df.write.parquet(path, compression="zstd")
        _STORED[key] = (path, df.schema)
    path, struct = _STORED[key]
    return spark.read.schema(struct).parquet(path)


def stored_rows(spark, sf_dir, name, build):
    """(the clustered rows, the others) of ``build``, which gives them as ``features.clustered_rows``; once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        clustered, rest = build(spark, sf_dir)
        path = fresh_dir(spark, f"{name}-rest")
        rest.write.parquet(path, compression="zstd")
        _STORED[key] = (clustered, path, rest.schema)
    clustered, path, struct = _STORED[key]
    return spark.table(clustered), spark.read.schema(struct).parquet(path)


def message_log(spark, sf_dir):
    """``event_messages`` as a stored log, spread like the segments of a topic's partitions."""
    return stored(spark, sf_dir, "message-log", event_messages)


def event_messages(spark, sf_dir):
    """The event transactions as wire messages, with the faults a topic really carries.

    Times alternate between epoch milliseconds and ISO text, coordinates between
    both spellings; some messages lack keys, hold nulls, numbers where text is
    due, too many decimals, numbers and times that overflow, or are no JSON at all.
    """
    e = F.col("kafka_offset")
    every = lambda n: e % n == 0
    t = txn_events(spark, sf_dir)
    when_text = lambda c: F.when(
        e % 2 == 0, F.unix_millis(c).cast("string")
    ).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    place = F.col("location")
    long_keys, short_keys = every(3), ~every(3)
    body = F.struct(
        "transaction_id",
        F.when(every(163), F.lit(None)).when(every(173), F.lit("9223372036854775807"))
        .otherwise(when_text(F.col("timestamp"))).alias("timestamp"),
        "customer_id", "card_number_last4", "card_type", "currency", "merchant_id",
        "merchant_name", "merchant_category_code", "merchant_category",
        F.struct(
            place["country"].alias("country"), place["state"].alias("state"),
            place["city"].alias("city"), place["zip_code"].alias("zip_code"),
            F.when(long_keys, place["latitude"]).alias("latitude"),
            F.when(long_keys, place["longitude"]).alias("longitude"),
            F.when(short_keys, place["latitude"]).alias("lat"),
            F.when(short_keys, place["longitude"]).alias("lon"),
        ).alias("location"),
        "channel", "status", "risk_score", "authorization_code", "processor_response_code",
        "is_international", "customer_present", "entry_method", "metadata",
        when_text(F.col("created_at")).alias("created_at"), "version",
    )
    amount = (
        F.when(every(139), F.lit('"12d"')).when(every(149), F.lit('"NaN"'))
        .when(every(157), F.lit('"1e400"'))
        .when(every(131), F.lit("12"))
        .when(every(137), F.lit('"abc"'))
        .when(every(107) & F.col("amount").isNotNull(),
              F.concat(F.lit('"'), F.col("amount").cast("string"), F.lit('5"')))
        .when(F.col("amount").isNull(), F.lit("null"))
        .otherwise(F.concat(F.lit('"'), F.col("amount").cast("string"), F.lit('"')))
    )
    text = F.when(
        every(5), F.to_json(body, {"ignoreNullFields": "false"})
    ).otherwise(F.to_json(body))
    message = F.concat(F.lit('{"amount":'), amount, F.lit(","), F.substring(text, F.lit(2),
                                                                            F.length(text)))
    return t.select(
        F.when(every(151), F.concat(F.lit("broken "), e.cast("string")))
        .otherwise(message).alias("value"),
        "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
    )


def avro_contract():
    """The Avro schema of the stand-in messages, as JSON text."""
    texts = ["transaction_id", "customer_id", "card_number_last4", "currency", "merchant_id", "merchant_name",
             "merchant_category_code", "status", "authorization_code", "processor_response_code"]
    enums = {"card_type": schema.CARD_TYPES, "merchant_category": schema.MERCHANT_CATEGORIES,
             "channel": schema.CHANNELS, "entry_method": schema.ENTRY_METHODS}
    place = [{"name": name, "type": ["null", "string"]} for name in ("country", "state", "city", "zip_code")]
    place += [{"name": name, "type": ["null", "double"]} for name in ("latitude", "longitude")]
    fields = [{"name": name, "type": ["null", "string"]} for name in texts]
    fields += [{"name": name, "type": ["null", {"type": "enum", "name": name, "symbols": symbols}]}
               for name, symbols in enums.items()]
    fields += [
        {"name": "amount", "type": ["null", {
            "type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2}]},
        {"name": "timestamp", "type": {"type": "long", "logicalType": "timestamp-micros"}},
        {"name": "created_at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "location", "type": ["null", {"type": "record", "name": "Place", "fields": place}]},
        {"name": "risk_score", "type": ["null", "double"]},
        {"name": "is_international", "type": ["null", "boolean"]},
        {"name": "customer_present", "type": ["null", "boolean"]},
        {"name": "metadata", "type": ["null", {"type": "map", "values": ["null", "string"]}]},
        {"name": "version", "type": "string"},
    ]
    return json.dumps({"type": "record", "name": "Transaction", "fields": fields})


def avro_log(spark, sf_dir):
    """The event transactions as framed Avro messages, some cut short, some without the frame's first byte."""
    e, contract = F.col("kafka_offset"), avro_contract()
    t = txn_events(spark, sf_dir).withColumns({
        "timestamp": F.unix_micros("timestamp"), "created_at": F.unix_millis("created_at")})
    body = F.struct(*[F.col(f["name"]) for f in json.loads(contract)["fields"]])
    sound = t.select(avro.to_avro(body, contract).alias("value"),
                     "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp")
    return sound.withColumn(
        "value", F.when(e % 302 == 0, F.expr("substring(value, 2)"))
        .when(e % 151 == 0, F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value")))


def event_alerts(spark, sf_dir):
    """Alert-shaped rows from the events, some out of contract."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        e,
        F.when(e % 41 != 0, F.concat(F.lit("al-"), e.cast("string"))).alias("alert_id"),
        F.concat(F.lit("txn-"), e.cast("string")).alias("transaction_id"),
        F.when(e % 43 == 0, F.lit("  ")).otherwise(F.col("user_id").cast("string"))
        .alias("customer_id_hash"),
        F.col("event_type").alias("alert_type"),
        F.when(F.col("event_type") == "view", F.lit("LOW"))
        .when(F.col("event_type") == "click", F.lit("MEDIUM"))
        .when(F.col("event_type") == "error", F.lit("HIGH"))
        .when(F.col("event_type") == "signup", F.lit("CRITICAL"))
        .otherwise(F.lit("SEVERE")).alias("severity"),
        (F.col("value") / 100).alias("risk_score"),
        (F.col("value") / 200).alias("confidence_score"),
    )
